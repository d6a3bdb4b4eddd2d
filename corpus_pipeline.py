"""The corpus pipeline: STAGES, run(spark, sf_dir) and ORACLE_SQL of tidemark.llm.pipeline, where the stages are written."""

from tidemark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
