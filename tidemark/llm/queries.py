"""The registered queries of the text operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .chat_format import OP7_SQL, op7_typed_parts
from .decontaminate import op5_spaced_seeds
from .language_id import op11_byte_convolution
from .mixing import op6_soft_membership
from .near_dups import OP10_SQL, op10_hyper_minhash
from .pii import op9_weak_supervision
from .pipeline import run
from .quality_classifier import op4_cumulative_link
from .quality_rules import op8_compression_bands
from .spelling import OP13_SQL, op13_prefix_suffix_tiles
from .substring_dedup import op2_gear_chunks
from .token_counts import op1_offset_attribution
from .toxicity import op3_bigru_attention
from .turn_repair import OP12_SQL, op12_survivor_coalescence


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_offset_attribution": op1_offset_attribution,
        "op2_gear_chunks": op2_gear_chunks,
        "op3_bigru_attention": op3_bigru_attention,
        "op4_cumulative_link": op4_cumulative_link,
        "op5_spaced_seeds": op5_spaced_seeds,
        "op6_soft_membership": op6_soft_membership,
        "op7_typed_parts": op7_typed_parts,
        "op9_weak_supervision": op9_weak_supervision,
        "pipeline": run,
        "op8_compression_bands": op8_compression_bands,
        "op10_hyper_minhash": op10_hyper_minhash,
        "op11_byte_convolution": op11_byte_convolution,
        "op12_survivor_coalescence": op12_survivor_coalescence,
        "op13_prefix_suffix_tiles": op13_prefix_suffix_tiles,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_typed_parts": OP7_SQL, "op10_hyper_minhash": OP10_SQL, "op12_survivor_coalescence": OP12_SQL, "op13_prefix_suffix_tiles": OP13_SQL}
