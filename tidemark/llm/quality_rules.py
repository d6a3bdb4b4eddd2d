"""Quality rules: compression bands.

A text is compressed whole and in fixed chunks of its UTF-8 bytes with zstandard. A ratio (compressed over raw bytes)
below the band for its length means repetition, one above it means noise that does not compress. The base rules
(word counts, symbols, repeated lines, repeated three-word windows) come with it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, quoted, table

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class Bands:
    """Bands by raw length: (bytes from, least ratio, greatest ratio). Shorter texts than the first are not judged.

    chunk: bytes of a chunk; a last chunk under least_chunk bytes is not judged. A text is rejected if more than
    chunk_share of its judged chunk bytes are out of the chunk's band.
    """

    whole: tuple[tuple[int, float, float], ...] = ((128, 0.30, 1.05), (512, 0.25, 0.80), (1024, 0.25, 0.72), (4096, 0.20, 0.68), (65536, 0.15, 0.65))
    chunk: int = 4096
    least_chunk: int = 1024
    chunk_band: tuple[float, float] = (0.20, 0.70)
    chunk_share: float = 0.5
    level: int = 3


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    h = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    with np.errstate(over="ignore"):
        key = (h[:-2] * ODD[0] + h[1:-1]) * ODD[1] + h[2:] * ODD[2]
    order = np.sort(key)
    same = order[1:] == order[:-1]
    if not same.any():
        return 0
    twice = order[1:][same]
    at = np.searchsorted(twice, key)
    at[at == len(twice)] = 0
    hit = twice[at] == key
    covered = np.zeros(n, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum())


def dup_lines(body: bytes) -> int:
    lines = [x for x in body.split(b"\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def bad_chunk_share(body: bytes, bands: Bands, pack: zstandard.ZstdCompressor) -> float:
    low, high = bands.chunk_band
    judged = bad = 0
    for i in range(0, len(body), bands.chunk):
        part = body[i : i + bands.chunk]
        if len(part) >= bands.least_chunk:
            judged += len(part)
            ratio = len(pack.compress(part)) / len(part)
            bad += len(part) * (not low <= ratio <= high)
    return bad / judged if judged else 0.0


def compression_rules(docs: DataFrame, bands: Bands = Bands(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: its base counts, ratios and verdict.

    Words are [^\\x20\\x09-\\x0D]+. Null and empty texts have no words, ratio null, and fail the base rules. Texts
    under the first band's length are kept if they pass the base rules. Repeated rows give repeated rows, an empty
    table gives none, a null doc_id stays null, and other columns are neither read nor returned. Texts are taken
    whole; memory holds one Arrow batch of them.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, ratio double, bad_chunks double, kept boolean"
    )

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        pack = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
        rows = []
        for body in bodies:
            body = body or b""
            words = body.split()
            n = len(words)
            dense = b"".join(words)
            chars = len(dense) - len(dense.translate(None, bytes(range(0x80, 0xC0)))) if not dense.isascii() else 0
            symbols = len(dense) - len(dense.translate(None, SYMBOLS))
            again = repeat_words(words)
            failed = n < 50 or 100 * again > 50 * n
            ratio = len(pack.compress(body)) / len(body) if body else None
            share = bad_chunk_share(body, bands, pack) if len(body) > bands.chunk else 0.0
            band = next((x for x in reversed(bands.whole) if len(body) >= x[0]), None)
            fine = band is None or (band[1] <= ratio <= band[2] and share <= bands.chunk_share)
            rows.append((n, len(dense) - chars, symbols, dup_lines(body), again, failed, ratio, share, fine and not failed))
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "bad_chunks", "kept")
        kinds = (*[pa.int64()] * 5, pa.bool_(), pa.float64(), pa.float64(), pa.bool_())
        return {"doc_id": kept[doc_id]} | {k: pa.array(v, t) for k, v, t in zip(names, zip(*rows, strict=True), kinds, strict=True)}

    docs = docs.select(quoted(doc_id).cast("long").alias(doc_id), quoted(text))
    return map_texts(docs, per_batch, schema, [doc_id], text)


def op8_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_rules(table(spark, sf_dir, "documents"))
