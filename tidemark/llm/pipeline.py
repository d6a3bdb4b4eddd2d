"""From raw documents to a weighted training corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result to the shared folder and reads it
again as the next one's docs. All but the last return the columns of docs, extra ones whatever their names as well; the last returns for each kept
document its rate and domain posteriors. docs has doc_id, text, lang, source and n_chars. No stage looks at the order of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import Scratch, table
from .decontaminate import decontaminated
from .mixing import mix
from .near_dups import one_of_each
from .pii import redacted
from .quality_classifier import graded, of_quality, train

LEAST_TAIL = 0.5
#: Parts of the tokens that the domains are to have at the end. The first stage has dropped most of what is low; less of it is asked for than is left
#: (3.5 % of the tokens of the given tables, by its posteriors), and less of what is toxic.
TARGETS = {"good": 0.92, "toxic": 0.05, "low": 0.03}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose probability of a grade over the lowest is under LEAST_TAIL.

    Null and empty texts are judged by the marks of an empty text, very long ones whole; rows without an id are judged like
    others; equal texts share their fate and repeated rows stay repeated; an empty table, or one without labels, loses no row to an error.
    """
    return of_quality(docs, train(docs, graded(table(spark, sf_dir, "labels"))), LEAST_TAIL)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id, and of rows with the same id one.

    Null and empty texts are in no group; rows without an id stay; very long texts are compared whole; an empty table stays empty.
    """
    return one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a part of the benchmark.

    Null and empty texts hold none and stay, as do rows without an id that hold none; very long texts are searched whole; repeated rows share their
    fate; an empty table on either side drops nothing.
    """
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind, and sets n_chars to the new length. Every row stays.

    Null texts stay null and empty ones empty (n_chars null and 0); very long texts are searched whole; repeated rows count
    as often in the fit; an empty table stays empty.
    """
    return redacted(docs, length="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every row the rate that makes the domains' expected tokens match TARGETS: doc_id, lang, source, n_chars, then what mix returns.

    Null and empty texts have no tokens and get the rate of the prior's posteriors; very long ones count with all their tokens; rows without an id
    are rated like others and repeated rows each; an empty table gives no rows.
    """
    return mix(docs, table(spark, sf_dir, "labels"), TARGETS, keep=("doc_id", "lang", "source", "n_chars"))


STAGES = [("quality", quality), ("near_dups", near_dups), ("benchmark", benchmark), ("personal", personal), ("mixing", mixing)]

#: Fitted models and hashed candidates have no SQL; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; of the stages' tables only the one that they read stays, none if a stage fails."""
    docs, tables = table(spark, sf_dir, "documents"), Scratch(spark)
    try:
        for name, stage in STAGES[:-1]:
            docs = tables.keep(stage(spark, docs, sf_dir), name)
            tables.drop(keep=(name,))
        return STAGES[-1][1](spark, docs, sf_dir)
    except BaseException:
        tables.drop()
        raise
