"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is the hash of the words at the set positions of a fixed mask; the other positions of the mask are ignored, so
a substituted word there doesn't break it. Seeds of the benchmark and of the texts are joined, and around each hit
the text is laid along the item without gaps: words that match count 1, others -1, and the best stretch decides.
Items too short for a mask are looked for whole, by the hash of all their words; those a little longer get masks of
fewer words, so that one word of them may be another.

Everything hangs on the text alone, so equal texts are looked at as one, by two 64-bit hashes that ids play no part in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, apart, quoted, table

#: Set positions. Of all pairs of masks of five words over eight at most that find a text with every third word substituted, this one misses the
#: fewest stretches of 12, 14, 16 and 18 words with 10, 11, 12 and 13 matches: none, 1.8 %, 2.2 % and 2.5 %.
MASKS = ((0, 1, 3, 4, 5), (0, 1, 3, 6, 7))
SHORTEST = min(m[-1] for m in MASKS) + 1
#: Added for items in which about every word counts: of six words or more with any one of them substituted, one of these matches somewhere.
CLOSE = ((0, 1, 2, 3), (0, 1, 4, 5))
#: Signs of scripts that have no spaces between words; each counts as a word. None of them is under U+0E00, which is asked first, as scripts are slow to look up.
UNSPACED = r"([\x{E00}-\x{10FFFF}&&[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]])"


@dataclass(frozen=True)
class Limits:
    """A stretch needs least_matches matching words, and a score (matches less other words) of least_score.

    Of an item of six words or more one word less than all is enough, with a score of two less; of a shorter one all words have to match.
    least_item: items under so many words are not looked for. Items of under SHORTEST words that more than common of all texts hold, and more than common_texts of them, are
    phrases of the language and no leaks: they count for nothing. broadcast_seeds: the benchmark's seeds are broadcast up to this
    count (24 bytes each); beyond, both sides are shuffled.
    """

    least_matches: int = 10
    least_score: int = 8
    least_item: int = 1
    common: float = 0.01
    common_texts: int = 100
    broadcast_seeds: int = 2_000_000

    def enough(self, n: Column, matches: Column, score: Column) -> Column:
        """Whether a stretch of an item of n words counts."""
        off = F.when(n >= SHORTEST, 1).otherwise(0)
        return (matches >= F.least(F.lit(self.least_matches), n - off)) & (score >= F.least(F.lit(self.least_score), n - 2 * off))


def words(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits of a text; null is empty."""
    lower = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNSPACED, " $1 ")
    return F.transform(F.filter(F.split(lower, r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.xxhash64(w))


def seeds(w: Column, mask: tuple[int, ...]) -> Column:
    """The seeds of a mask, by position."""
    last = F.size(w) - mask[-1] - 1
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.lit(str(mask)), *[F.get(w, i + p) for p in mask]))


def seed_rows(df: DataFrame, keep: list[str], at: str, masks: tuple[tuple[int, ...], ...] = MASKS) -> DataFrame:
    """df(keep, w) exploded to (keep, position, seed)."""
    every = F.array(*[seeds(F.col("w"), m) for m in masks])
    return df.select(*keep, F.explode(every).alias("s")).select(*keep, F.posexplode("s").alias(at, "seed"))


def identity(text: Column) -> tuple[Column, Column]:
    """128 bits that a text is known by, as h and g."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def stretch(doc: Column, item: Column, shift: Column) -> Column:
    """Of an item's words laid at position shift of doc: the best stretch as (score, matches); of several with the best score, one with the most matches."""
    lo, hi = F.greatest(F.lit(0), -shift), F.least(F.size(item), F.size(doc) - shift) - 1
    zero = F.struct(*[F.lit(0).alias(k) for k in ("run", "hits", "score", "matches")])

    def step(a: Column, i: Column) -> Column:
        same = F.get(item, i) == F.get(doc, i + shift)
        fresh = a["run"] < 0
        run = F.when(fresh, 0).otherwise(a["run"]) + F.when(same, 1).otherwise(-1)
        hits = F.when(fresh, 0).otherwise(a["hits"]) + F.when(same, 1).otherwise(0)
        better = (run > a["score"]) | ((run == a["score"]) & (hits > a["matches"]))
        return F.struct(run.alias("run"), hits.alias("hits"), F.when(better, run).otherwise(a["score"]).alias("score"), F.when(better, hits).otherwise(a["matches"]).alias("matches"))

    return F.aggregate(F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>")), zero, step, lambda a: F.struct(a["score"].alias("score"), a["matches"].alias("matches")))


def leaks(texts: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(h, g, items, matches) of the texts that overlap with benchmark(item_id, text): items are the sorted item ids.

    texts(text), each with its identity. Null and empty texts and items have no words and are never in the result. An item of SHORTEST words or
    more is found by its seeds, a shorter one by all its words, which a text has to hold in a row. Very long texts are
    laid along an item in its length only. Ties and repeated items or texts change nothing but that the ids of equal items are all
    listed, and items without an id are found but not listed.
    """
    tables = Scratch(texts.sparkSession)
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") >= max(1, limits.least_item))
    items = tables.keep(items.withColumn("i", F.xxhash64("w")), "items")
    kinds = items.select("i", "w").dropDuplicates(["i"]).withColumn("n", F.size("w"))  # equal items are looked for once
    most = limits.least_matches + 1
    few = sorted(r["n"] for r in kinds.filter((F.col("n") <= most) | (F.col("n") < SHORTEST)).select("n").distinct().collect())  # a few numbers
    lengths = tuple(tuple(range(n)) for n in few if n < SHORTEST)  # masks without a gap
    close = CLOSE if few and few[-1] >= SHORTEST else ()
    theirs = seed_rows(kinds.filter(F.col("n") >= SHORTEST), ["i", "n"], "at_item")
    if close:
        theirs = theirs.unionByName(seed_rows(kinds.filter(F.col("n").between(SHORTEST, most)), ["i", "n"], "at_item", close))
    for m in lengths:
        theirs = theirs.unionByName(seed_rows(kinds.filter(F.col("n") == len(m)), ["i", "n"], "at_item", (m,)))
    theirs = tables.keep(theirs.distinct(), "seeds")
    known = F.broadcast(theirs) if theirs.count() <= limits.broadcast_seeds else theirs
    h, g = identity(F.col("text"))
    texts = texts.select(h.alias("h"), g.alias("g"), "text")
    ours = seed_rows(texts.select("h", "g", words(F.col("text")).alias("w")), ["h", "g"], "at_doc", MASKS + close + lengths)
    hits = ours.join(known, "seed").select("h", "g", "i", "n", (F.col("at_doc") - F.col("at_item")).alias("shift")).distinct()
    hits = tables.keep(hits, "hits")
    if lengths:
        held = hits.filter(F.col("n") < SHORTEST).select("i", "h", "g").distinct().groupBy("i").agg(F.count("*").alias("texts"))
        many = texts.select("h", "g").distinct().count()
        common = held.filter(F.col("texts") > max(limits.common_texts, limits.common * many)).select("i")
        hits = hits.join(common, "i", "left_anti")
    # the hit texts are few, so AQE can broadcast their hashes if they really are
    found = texts.join(hits.select("h", "g").distinct(), ["h", "g"], "left_semi").dropDuplicates(["h", "g"])
    found = found.select("h", "g", words(F.col("text")).alias("doc"))
    # only the words that the item is laid along go on from here
    part = F.slice("doc", F.greatest(F.col("shift"), F.lit(0)) + 1, F.col("n"))
    laid = hits.join(found, ["h", "g"]).select("h", "g", "i", "n", F.least(F.col("shift"), F.lit(0)).alias("shift"), part.alias("part"))
    laid = laid.join(kinds.select("i", F.col("w").alias("item")), "i")
    best = laid.select("h", "g", "i", "n", stretch(F.col("part"), F.col("item"), F.col("shift")).alias("b"))
    best = best.filter(limits.enough(F.col("n"), F.col("b.matches"), F.col("b.score"))).join(items.select("i", "item_id"), "i")
    out = best.groupBy("h", "g").agg(F.array_sort(F.collect_set("item_id")).alias("items"), F.max("b.matches").alias("matches"))
    out = tables.keep(out, "leaks")
    tables.drop(keep=("leaks",))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """A row for each row of docs(doc_id, text) that holds a part of the benchmark: doc_id, items, n_items, matches.

    A null doc_id stays null; repeated rows give repeated rows; an empty table on either side gives none; other columns are not read.
    """
    bad = leaks(docs.select("text"), benchmark, limits)
    h, g = identity(F.col("text"))
    marked = docs.select("doc_id", h.alias("h"), g.alias("g")).join(bad, ["h", "g"])
    return marked.select("doc_id", "items", F.size("items").alias("n_items"), "matches")


def decontaminated(docs: DataFrame, benchmark: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of docs, with all their columns, that hold no part of the benchmark; null texts hold none."""
    bad_h, bad_g = apart(["h", "g"], docs.columns)
    bad = leaks(docs.select("text"), benchmark, limits).select(F.col("h").alias(bad_h), F.col("g").alias(bad_g))
    h, g = identity(F.col("text"))
    return docs.join(bad, (h == F.col(bad_h)) & (g == F.col(bad_g)), "left_anti").select(*map(quoted, docs.columns))


def op5_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
