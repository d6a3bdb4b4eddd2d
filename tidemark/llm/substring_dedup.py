"""Substring dedup by content-defined chunking.

A gear hash rolls over the UTF-8 bytes; a chunk ends where its last bits fall under a threshold, so that chunks follow the content
and an insertion only shifts the chunks that it touches. Chunks are deduplicated by digest over all documents; runs of
chunks that occur elsewhere too are repeated_passages, which lose up to a chunk at either end.

exact_passages loses nothing: its chunks hold a fixed count of words and end where the gear hash is the least of a stretch of words, so that
every passage of the least length holds one of them whole. Around those that repeat, the windows of the least length are compared by digest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, map_texts, materialise, table

#: The hash has 16 bits and a byte moves out after 16 shifts, so a boundary depends on the 16 bytes before it alone.
WINDOW = 16
GEAR = np.random.default_rng(7919).integers(0, 2**16, 256, dtype=np.uint16)


@dataclass(frozen=True)
class Chunking:
    """mean: bytes between boundaries beyond the least; least, most: bytes of a chunk (most can be passed by 3 bytes of a character)."""

    mean: int = 24
    least: int = 8
    most: int = 128


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """At each byte the sum of GEAR of it and the 15 before, shifted by their distance, by doubling the window four times."""
    h = GEAR[raw]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint16(width)
        width *= 2
    return h


def boundaries(body: bytes, how: Chunking) -> np.ndarray:
    """Ends of the chunks, in bytes; a chunk doesn't end inside a character."""
    raw = np.frombuffer(body, np.uint8)
    n = len(raw)
    whole = np.ones(n, bool)
    whole[:-1] = (raw[1:] & 0xC0) != 0x80
    at = np.flatnonzero((gear_hash(raw) < 2**16 // how.mean) & whole) + 1
    ends, last = [], 0
    for e in at.tolist():
        while e - last > how.most:
            last += how.most
            while last < n and raw[last] & 0xC0 == 0x80:
                last += 1
            ends.append(last)
        if e - last >= how.least:
            ends.append(e)
            last = e
    while n - last > how.most:
        last += how.most
        while last < n and raw[last] & 0xC0 == 0x80:
            last += 1
        ends.append(last)
    if last < n:
        ends.append(n)
    return np.array(ends)


def chunks(docs: DataFrame, how: Chunking = Chunking()) -> DataFrame:
    """(doc_id, start, end, digest) of every chunk; start and end in code points. docs(doc_id, text)."""

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        row, start, end, digest = [], [], [], []
        for i, body in enumerate(bodies):
            if not body:
                continue
            ends = boundaries(body, how)
            view, begin = memoryview(body), 0
            for e in ends.tolist():
                digest.append(xxhash.xxh3_64_intdigest(view[begin:e]))
                begin = e
            if not body.isascii():
                ends = np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)[ends - 1]
            row.append(np.full(len(ends), i))
            start.append(np.append(0, ends[:-1]))
            end.append(ends)
        row, start, end = (np.concatenate(x) if x else np.empty(0, int) for x in (row, start, end))
        ids = kept["doc_id"].take(pa.array(row, pa.int64()))
        return {"doc_id": ids, "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()), "digest": pa.array(np.array(digest, np.uint64).view(np.int64))}

    return map_texts(docs, per_batch, "doc_id long, start int, end int, digest long", ["doc_id"])


def repeated_passages(docs: DataFrame, least_chars: int = 128, how: Chunking = Chunking(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of at least least_chars characters of chunks that occur twice or more in docs.

    One row for each run: doc_id, start, end (code points), n_chunks, kept_chars (in chunks whose first occurrence by
    doc_id and start this is) and dropped_chars (in later ones). The first occurrences are in the result as well,
    so that every document of a repetition is. Null and empty texts have no chunks; rows with a null doc_id are left
    out, as a run needs its document; rows that repeat a doc_id count as one document with the chunks of both. An
    empty table gives no rows; other columns are not read.

    A digest has 64 bits and is compared together with the length; a run that is only a collision would need one chunk
    of least_chars, or several collisions in a row.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id is not null")
    every = materialise(chunks(docs, how), "chunks")
    size = (F.col("end") - F.col("start")).alias("size")
    key = every.select("digest", size, "doc_id", "start")
    again = key.groupBy("digest", "size").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "start")).alias("first")).filter("n > 1")
    again = materialise(again.select("digest", "size", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first_start")), "digests")
    found = every.withColumn("size", F.col("end") - F.col("start")).join(again, ["digest", "size"])
    is_first = (F.col("doc_id") == F.col("first_doc")) & (F.col("start") == F.col("first_start"))
    found = found.select("doc_id", "start", "end", is_first.alias("is_first"))
    in_doc = Window.partitionBy("doc_id").orderBy("start", "end")
    fresh = F.when(F.col("start") <= F.lag("end").over(in_doc), 0).otherwise(1)
    runs = found.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(in_doc))
    out = runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        F.count("*").alias("n_chunks"),
        F.sum(F.when(F.col("is_first"), F.col("end") - F.col("start")).otherwise(0)).alias("kept_chars"),
        F.sum(F.when(F.col("is_first"), 0).otherwise(F.col("end") - F.col("start"))).alias("dropped_chars"),
    )
    return out.filter(F.col("end") - F.col("start") >= least_chars).drop("run")


#: Bytes of ASCII spaces, and the other spaces of Unicode in UTF-8; what str.split() splits at.
SPACE = np.isin(np.arange(256), [*range(9, 14), *range(28, 33)])
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


@dataclass(frozen=True)
class Exact:
    """least: words of the shortest passage. seed: words of a chunk; of each least - seed + 1 chunks in a row, the one that ends at the least gear hash counts.

    seed is under least, and 9 or more, so that a chunk holds the 16 bytes of the hash.
    """

    least: int = 51
    seed: int = 26


def word_bounds(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words, in bytes."""
    if not body.isascii():
        body = WIDE_SPACE.sub(lambda m: b" " * len(m[0]), body)
    gap = SPACE[np.frombuffer(body, np.uint8)]
    edge = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    return edge[::2], edge[1::2]


def seeds(body: bytes, ends: np.ndarray, how: Exact) -> np.ndarray:
    """For each window of how.least words the first word of its chunk of how.seed words: the first of those with the least gear hash at their ends.

    The hash sees 16 bytes, which the chunk holds, so which chunk of a passage counts depends on the passage alone.
    """
    if len(ends) < how.least:
        return np.empty(0, np.int64)
    key = gear_hash(np.frombuffer(body, np.uint8))[ends[how.seed - 1 :] - 1].astype(np.int64) << 40
    key |= np.arange(len(key))
    width, span = how.least - how.seed + 1, 1
    while span < width:
        by = min(span, width - span)
        key, span = np.minimum(key[:-by], key[by:]), span + by
    return key & (2**40 - 1)


def _signed(digests: list[int]) -> pa.Array:
    return pa.array(np.array(digests, np.uint64).view(np.int64))


def seed_pieces(docs: DataFrame, how: Exact) -> DataFrame:
    """(doc_id, h, at, to, digest), at and to in words: the chunks of how.seed words, and from the start of each to the end of the first one that makes it how.least."""

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        row, first, last, digest = [], [], [], []
        for i, body in enumerate(bodies):
            if not body:
                continue
            starts, ends = word_bounds(body)
            at = seeds(body, ends, how)
            if not len(at):
                continue
            at = at[np.append(True, at[1:] != at[:-1])]
            on = np.searchsorted(at, at + how.least - how.seed)
            long = on < len(at)
            a, b = np.append(at, at[long]), np.append(at, at[on[long]]) + how.seed
            view = memoryview(body)
            digest += [xxhash.xxh3_64_intdigest(view[s:e]) for s, e in zip(starts[a].tolist(), ends[b - 1].tolist(), strict=True)]
            row.append(np.full(len(a), i))
            first.append(a)
            last.append(b)
        row, first, last = (np.concatenate(x) if x else np.empty(0, int) for x in (row, first, last))
        ids = {k: kept[k].take(pa.array(row, pa.int64())) for k in ("doc_id", "h")}
        return ids | {"at": pa.array(first, pa.int32()), "to": pa.array(last, pa.int32()), "digest": _signed(digest)}

    return map_texts(docs, per_batch, "doc_id long, h long, at int, to int, digest long", ["doc_id", "h"])


def _highest(n: int, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each of 0..n-1 the highest x of the stretches from lo to hi, both included, that hold it, or 0."""
    size = hi - lo + 1
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
    out = np.zeros(n, np.int64)
    np.maximum.at(out, at, np.repeat(x, size))
    return out


def _stretches(x: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(x, prepend=False, append=False)).tolist()
    return zip(edge[::2], edge[1::2], strict=True)


def windows(docs: DataFrame, how: Exact) -> DataFrame:
    """(doc_id, h, at, to, start, end, digest, sure, later) from docs(doc_id, h, text, found), found being the repeated pieces (at, to, n, is_first).

    Stretches of windows inside repeated pieces have one row without a digest; later are those inside pieces that occur before. A window of
    how.least words whose chunk repeats has a row and digest, unless it is later, or inside a piece that occurs as often as its
    chunk, so that it is nowhere else and first where the piece is. sure says that it is inside a repeated piece.
    start and end are in code points.
    """

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        row, first, last, start, end, digest, sure, past = [], [], [], [], [], [], [], []
        found = kept["found"]
        flat, offsets = found.flatten(), found.offsets.to_numpy()
        at, to, times, is_first = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("at", "to", "n", "is_first"))
        offsets = offsets - offsets[0]
        for i, body in enumerate(bodies):
            mine = slice(offsets[i], offsets[i + 1])
            a, b, t, f = at[mine].astype(np.int64), to[mine].astype(np.int64), times[mine], is_first[mine]
            starts, ends = word_bounds(body)
            n, piece = len(starts) - how.least + 1, b - a >= how.least
            of_chunk = np.zeros(len(starts), np.int64)
            of_chunk[a[~piece]] = t[~piece]
            of_chunk = of_chunk[seeds(body, ends, how)]
            of_piece = _highest(n, a[piece], b[piece] - how.least, t[piece])
            later = _highest(n, a[piece & ~f], b[piece & ~f] - how.least, t[piece & ~f]) > 0
            known = ~later & (of_piece > 0)
            alone = np.flatnonzero((of_chunk > 0) & ~later & (of_piece != of_chunk))
            runs = np.array([*_stretches(later), *_stretches(known)], np.int64).reshape(-1, 2)
            x, y = np.append(runs[:, 0], alone), np.append(runs[:, 1] - 1, alone) + how.least
            s, e = starts[x], ends[y - 1]
            view = memoryview(body)
            digest += [None] * len(runs)
            digest += [xxhash.xxh3_64_intdigest(view[p:q]) for p, q in zip(s[len(runs) :].tolist(), e[len(runs) :].tolist(), strict=True)]
            if not body.isascii():
                points = np.cumsum((np.frombuffer(body, np.uint8) & 0xC0) != 0x80)
                s, e = points[s] - 1, points[e - 1]
            sure.append(np.append(np.ones(len(runs), bool), of_piece[alone] > 0))
            past.append(np.append(later[runs[:, 0]], np.zeros(len(alone), bool)))
            row.append(np.full(len(x), i))
            first.append(x)
            last.append(y)
            start.append(s)
            end.append(e)
        row, first, last, start, end, sure, past = (np.concatenate(v) for v in (row, first, last, start, end, sure, past))
        none = np.array([d is None for d in digest], bool)
        digests = pa.array(np.array([d or 0 for d in digest], np.uint64).view(np.int64), mask=none)
        out = {k: kept[k].take(pa.array(row, pa.int64())) for k in ("doc_id", "h")}
        out |= {k: pa.array(v, pa.int32()) for k, v in (("at", first), ("to", last), ("start", start), ("end", end))}
        return out | {"digest": digests, "sure": pa.array(sure), "later": pa.array(past)}

    schema = "doc_id long, h long, at int, to int, start int, end int, digest long, sure boolean, later boolean"
    return map_texts(docs, per_batch, schema, ["doc_id", "h", "found"])


def _repeated(rows: DataFrame) -> DataFrame:
    """(digest, n, first) of the digests that occur twice or more, from rows(digest, place); first is the least place."""
    return rows.groupBy("digest").agg(F.count("*").cast("int").alias("n"), F.min("place").alias("first")).filter("n > 1")


def exact_passages(docs: DataFrame, how: Exact = Exact(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every passage of how.least words or more in a row, with what is between them, that occurs twice or more in docs.

    One row for each run of such passages that touch: doc_id, start, end (code points), n_words, dropped_chars (in passages that occur
    before, by doc_id and place) and kept_chars (the rest). The first occurrences are in the result as well. Words are runs of
    signs without spaces. Null and shorter texts have no passage; rows with a null doc_id are left out; different texts with
    the same doc_id are looked at each. An empty table gives no rows; other columns are not read.

    Which chunk of how.seed words a window of how.least words has depends on the window alone, so a window can repeat only if its chunk does, and
    all such windows are compared, but for those that the count of a longer piece settles. Digests have 64 bits and are not compared further.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text")).filter("doc_id is not null")
    tables = Scratch(docs.sparkSession)
    every = tables.keep(seed_pieces(docs, how), "chunks")
    place, is_piece = F.struct("doc_id", "at"), F.col("to") - F.col("at") >= how.least
    again = tables.keep(_repeated(every.select("digest", F.when(is_piece, place).alias("place"))), "digests")
    is_first = F.coalesce(place == F.col("first"), F.lit(False)).alias("is_first")
    found = every.join(again, "digest").select("doc_id", "h", F.struct("at", "to", "n", is_first).alias("piece"))
    found = found.groupBy("doc_id", "h").agg(F.collect_list("piece").alias("found"))
    near = tables.keep(windows(docs.join(found, ["doc_id", "h"]), how), "windows")
    tables.drop(keep=("windows",))
    alone = near.filter("digest is not null")
    again = tables.keep(_repeated(alone.select("digest", place.alias("place"))), "repeated")
    alone = alone.join(again, "digest").withColumn("later", place != F.col("first")).filter(F.col("later") | ~F.col("sure"))
    columns = ["doc_id", "h", "at", "to", "start", "end", "later"]
    known = near.filter("digest is null").select(*columns).unionByName(alone.select(*columns))
    before = Window.partitionBy("doc_id", "h").orderBy("start", "end", "later").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.col("start") <= F.max("end").over(before), 0).otherwise(1)
    past = F.coalesce(F.max(F.when(F.col("later"), F.col("end"))).over(before), F.lit(0))
    dropped = F.when(F.col("later"), F.greatest(F.lit(0), F.col("end") - F.greatest("start", past))).otherwise(0)
    runs = known.withColumn("fresh", fresh).withColumn("dropped", dropped)
    runs = runs.withColumn("run", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    out = runs.groupBy("doc_id", "h", "run").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("to") - F.min("at")).alias("n_words"),
        F.sum("dropped").alias("dropped_chars"),
    )
    return out.select("doc_id", "start", "end", "n_words", (F.col("end") - F.col("start") - F.col("dropped_chars")).alias("kept_chars"), "dropped_chars")


def op2_gear_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_passages(table(spark, sf_dir, "documents"))
