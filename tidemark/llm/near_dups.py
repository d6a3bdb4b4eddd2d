"""MinHash near-dedup with HyperMinHash registers.

A register keeps of a bucket's smallest shingle hash the count of leading zeros (6 bits) and the 10 bits after the
first one. Bands of four registers propose candidates, a Jaccard estimate corrected for chance collisions of the
compressed registers thins them out, and the full shingle sets confirm each link.

Two ways fill the 128 buckets. Texts with up to SMALL_MOST shingles hash every shingle anew for each bucket, so none is
empty; texts with LARGE_LEAST or more deal their shingles out to the buckets. Texts in between do both, so any
two texts of a similarity of 3/4 have a way in common. At that similarity a band misses with 1 - 0.75^4, all 32 with
5e-6.

Identical sets become one class before all else; classes that one doc_id has (with several texts) are joined at once. Then:
1. In each bucket of a band every class is paired with two leaders only: the class that shares most buckets with most others, which
   in a group of near copies is the one that was edited least, and one drawn by hash. In each round a class
   takes the best by estimate of the pairs that lead to another component to the full sets, until a round joins few. That joins large groups.
2. What then shares a bucket without sharing a component is compared in blocks: the classes outside of the bucket's
   largest component against all of the bucket, by registers and then by the 512 smallest hashes, which are all of small
   sets. Every pair that passes goes to the full sets. A block is large, so a class is copied once for each 1024 of
   its bucket: for each comparison under 6 bytes are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, apart, map_texts, quoted, table
from .components import components

WORDS = 5
REGISTERS = 128
ROWS = 4
BANDS = REGISTERS // ROWS
MANTISSA = 10
SMALL_MOST, LARGE_LEAST = 344, 256
#: Links need this percentage of the union; estimates need LEAST_ESTIMATE, four deviations of 128 registers below it.
PERCENT = 75
LEAST_ESTIMATE = 0.60
#: In blocks the FINE smallest hashes decide after that: all of a set, or of a larger one a sample with a deviation of 0.019.
FINE = 512
LEAST_EXACT, LEAST_SAMPLED = 0.74, 0.66
#: Classes on either side of a block, and of what numpy compares at once.
BLOCK, TILE = 1024, 128
#: Rounds go on while they join at least this part of the pairs that they look at.
LEAST_JOINED = 0.05
CACHED_WORDS = 500_000

_P, _C1, _C2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_draw = np.random.default_rng(20240607)
_A = (_draw.integers(0, 2**63, REGISTERS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _draw.integers(0, 2**63, REGISTERS, dtype=np.uint64)


class WordHashes(dict):
    """Hashes of words, kept as long as there are not too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(body: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a text with A-Z lower-cased."""
    words = (body or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(n, WORDS)
    m = n - k + 1
    x = h[:m] + np.uint64(k)
    for j in range(1, k):
        x *= _P
        x += h[j : m + j]
    x ^= x >> np.uint64(30)
    x *= _C1
    x ^= x >> np.uint64(27)
    x *= _C2
    x ^= x >> np.uint64(31)
    return np.unique(x)


def registers(least: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of 64-bit minima in 16 bits, never 0."""
    bits = np.maximum(least, np.uint64(1)).astype(np.float64).view(np.uint64)
    power = np.minimum((bits >> np.uint64(52)).astype(np.int64) - 1023, 63)
    mantissa = (bits >> np.uint64(52 - MANTISSA)).astype(np.int64) & ((1 << MANTISSA) - 1)
    return np.maximum(((63 - power) << MANTISSA) | mantissa, 1).astype("<u2")


def signature_small(x: np.ndarray) -> bytes:
    return registers((_A[:, None] * x[None, :] + _B[:, None]).min(axis=1)).tobytes()


def signature_large(x: np.ndarray) -> bytes:
    shift = np.uint64(64 - REGISTERS.bit_length() + 1)
    start = np.searchsorted(x, np.arange(REGISTERS, dtype=np.uint64) << shift)
    full = np.diff(np.append(start, len(x))) > 0
    out = np.zeros(REGISTERS, "<u2")
    out[full] = registers(x[start[full]] << np.uint64(64 - int(shift)))
    return out.tobytes()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n_shingles, digest of the set, signature of either way or null); docs(doc_id, h, text)."""

    hashes = WordHashes()

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        n, digest, small, large = [], [], [], []
        for body in bodies:
            x = shingles(body, hashes)
            n.append(len(x))
            digest.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
            small.append(signature_small(x) if 0 < len(x) <= SMALL_MOST else None)
            large.append(signature_large(x) if len(x) >= LARGE_LEAST else None)
        return kept | {"n_shingles": pa.array(n, pa.int64())} | {k: pa.array(v, pa.binary()) for k, v in (("digest", digest), ("small", small), ("large", large))}

    return map_texts(docs, per_batch, "doc_id long, h long, n_shingles long, digest binary, small binary, large binary", ["doc_id", "h"])


def chance(n: np.ndarray) -> np.ndarray:
    """For sets of n hashes to a bucket, the chance of each count of leading zeros of the smallest."""
    i = np.arange(64.0)
    n = np.maximum(n.astype(float), 1)[:, None]
    return (1 - 2.0 ** -(i + 1)) ** n - (1 - 2.0**-i) ** n


def estimate(equal: np.ndarray, of: np.ndarray, collide: np.ndarray) -> np.ndarray:
    """Jaccard from the equal share of the registers that are not empty in both, less what collides by chance."""
    return (equal / np.maximum(of, 1) - collide) / (1 - collide)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, REGISTERS)


def estimates(pairs: DataFrame) -> DataFrame:
    """pairs(a, b, way, na, nb, sa, sb) with their estimate, those under LEAST_ESTIMATE left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (batch.slice(at, 4096) for batch in batches for at in range(0, batch.num_rows, 4096)):
            x, y = _matrix(b.column("sa")), _matrix(b.column("sb"))
            per = np.where(b.column("way").to_numpy() > 0, REGISTERS, 1)
            cx, cy = (chance(b.column(c).to_numpy() / per) for c in ("na", "nb"))
            est = estimate(((x == y) & (x > 0)).sum(1), ((x > 0) | (y > 0)).sum(1), (cx * cy).sum(1) / 2**MANTISSA)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(est)], names=["a", "b", "est"]).filter(pa.array(est >= LEAST_ESTIMATE))

    return pairs.select("a", "b", "way", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long, est double")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs(a, b), the links by their full shingle sets, as (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, theirs = WordHashes(), None, None
        for batch in batches:
            out = []
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if b != last:
                    last, theirs = b, shingles(y, hashes)
                mine = shingles(x, hashes)
                both = len(np.intersect1d(mine, theirs, assume_unique=True))
                if 100 * both >= PERCENT * (len(mine) + len(theirs) - both):
                    out.append((a, b))
            u, v = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    left = texts.select(F.col("rep").alias("a"), F.col("body").alias("x"))
    right = texts.select(F.col("rep").alias("b"), F.col("body").alias("y"))
    both = pairs.select("a", "b").hint("merge").join(left.hint("merge"), "a").hint("merge").join(right.hint("merge"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "u long, v long")


def with_fine(texts: DataFrame) -> DataFrame:
    """Adds to texts(rep, body) fine: the upper halves of the FINE smallest shingle hashes, in order."""
    hashes = WordHashes()

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        fine = [(shingles(b, hashes)[:FINE] >> np.uint64(32)).astype("<u4").tobytes() for b in bodies]
        return {"rep": kept["rep"], "body": pa.array(bodies, pa.binary()), "fine": pa.array(fine, pa.binary())}

    return map_texts(texts, per_batch, "rep long, body binary, fine binary", ["rep"], "body")


def close(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets, by their smallest hashes in order, may be as similar as a link asks."""
    both = np.intersect1d(x, y)
    if max(len(x), len(y)) < FINE:
        return len(both) >= LEAST_EXACT * (len(x) + len(y) - len(both))
    union = np.union1d(x, y)[:FINE]  # the smallest hashes of the union: both sides have all of these that are theirs
    return np.searchsorted(both, union[-1], "right") >= LEAST_SAMPLED * len(union)


def compared(s: list[dict], t: list[dict], band: int, way: int) -> Iterator[tuple[int, int]]:
    """Of seekers s and others t, the pairs of different components that pass both estimates and don't meet in an earlier band."""
    x, y = (np.frombuffer(b"".join(r["sig"] for r in side), "<u2").reshape(-1, REGISTERS) for side in (s, t))
    (xr, xc, xn), (yr, yc, yn) = (tuple(np.array([r[k] for r in side]) for k in ("rep", "comp", "n")) for side in (s, t))
    ys = np.array([r["seeks"] for r in t])
    fits = (100 * np.minimum.outer(xn, yn) >= PERCENT * np.maximum.outer(xn, yn)) & (xc[:, None] != yc[None, :]) & (~ys[None, :] | (xr[:, None] < yr[None, :]))
    if not fits.any():
        return
    same = x[:, None, :] == y[None, :, :]
    full = (x > 0)[:, None, :]
    of = REGISTERS - ((x == 0).astype(np.int32) @ (y == 0).astype(np.int32).T)
    per = REGISTERS if way else 1
    est = estimate((same & full).sum(2), of, chance(xn / per) @ chance(yn / per).T / 2**MANTISSA)
    first = same.reshape(len(x), len(y), BANDS, ROWS).all(3) & full.reshape(len(x), 1, BANDS, ROWS).any(3)
    for i, j in zip(*(fits & (est >= LEAST_ESTIMATE) & (first.argmax(2) == band)).nonzero(), strict=True):
        if close(np.frombuffer(s[i]["fine"], "<u4"), np.frombuffer(t[j]["fine"], "<u4")):
            yield s[i]["rep"], t[j]["rep"]


def block_pairs(blocks: DataFrame) -> DataFrame:
    """Pairs that pass both estimates, from blocks(band, way, seekers, others), lists of (rep, comp, n, sig, fine, seeks).

    A pair that meets in several bands comes from the first one only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            row = row.to_pylist()[0]
            tiles = [[side[i : i + TILE] for i in range(0, len(side), TILE)] for side in (row["seekers"], row["others"])]
            pairs = [p for s in tiles[0] for t in tiles[1] for p in compared(s, t, row["band"], row["way"])]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], names=["a", "b"])

    return blocks.select("band", "way", "seekers", "others").mapInArrow(run, "a long, b long")


def _bands(sigs: DataFrame) -> DataFrame:
    """(key, band, way, rep) of sigs(rep, way, sig); bands of empty registers only are left out."""
    pieces = F.posexplode(F.array(*[F.substring("sig", 1 + 2 * ROWS * i, 2 * ROWS) for i in range(BANDS)])).alias("band", "piece")
    rows = sigs.select("rep", "way", pieces).filter(F.col("piece") != F.unhex(F.lit("00" * 2 * ROWS)))
    return rows.select(F.xxhash64("way", "band", "piece").alias("key"), "band", "way", "rep")


def named(pairs: DataFrame, comps: DataFrame, u: str, v: str) -> DataFrame:
    """Adds to pairs the components of both sides, as cu and cv for sides u and v; a class in no link is its own."""
    for c in (u, v):
        side = comps.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        pairs = pairs.join(side, c, "left").withColumn(f"c{c}", F.coalesce(f"c{c}", c))
    return pairs


def absorb(comps: DataFrame, links: DataFrame, tables: Scratch) -> DataFrame:
    """comps(node, component) after links(u, v) have joined some of them."""
    ends = named(links, comps, "u", "v").select(F.col("cu").alias("u"), F.col("cv").alias("v"))
    joined = tables.keep(components(ends, tables), "joined")
    moved = comps.join(joined.select(F.col("node").alias("component"), F.col("component").alias("c")), "component", "left")
    moved = moved.select("node", F.coalesce("c", "component").alias("component"))
    return tables.keep(moved.unionByName(joined.join(comps, "node", "left_anti")), "comps")


def bridges(usable: DataFrame, classes: DataFrame, many: DataFrame) -> DataFrame:
    """Links (u, v) between the classes that one doc_id of many has."""
    held = usable.select("doc_id", "digest").join(many, "doc_id", "left_semi").distinct().join(classes.select("digest", "rep"), "digest")
    least = held.groupBy("doc_id").agg(F.min("rep").alias("v"))
    return held.join(least, "doc_id").select(F.col("rep").alias("u"), "v").filter("u <> v")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, n_class (rows of its very set) and kept.

    Null and empty texts and those of white space alone have no shingles and are linked with nothing; nor are rows without a
    doc_id, whose component_id is null and which are kept. Texts of one to four words have one shingle. Repeated rows
    give repeated rows; rows that share a doc_id are one node, with the links of all their texts, in whatever order they come. Very long
    texts are taken whole, one Arrow batch of them at a time. An empty table gives none. Other columns, whatever their names,
    are neither read nor returned.
    """
    spark, tables = docs.sparkSession, Scratch(docs.sparkSession)
    docs = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("binary").alias("text")).withColumn("h", F.xxhash64("text"))
    sets = tables.keep(signatures(docs), "sets")
    usable = sets.filter("digest is not null and doc_id is not null")
    # a class is known by a number, and by the row of docs that stands for it: the least (doc_id, hash of the text)
    classes = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "h")).alias("first"), F.count("*").alias("n_class"))
    classes = tables.keep(classes.select(F.monotonically_increasing_id().alias("rep"), "digest", "first.*", "n_class"), "classes")
    firsts = usable.join(classes.drop("n_class"), ["digest", "doc_id", "h"]).dropDuplicates(["digest", "doc_id", "h"])
    either = F.explode(F.array(F.struct(F.lit(0).alias("way"), F.col("small").alias("sig")), F.struct(F.lit(1).alias("way"), F.col("large").alias("sig")))).alias("w")
    sigs = tables.keep(firsts.select("rep", F.col("n_shingles").alias("n"), either).select("rep", "n", "w.*").filter("sig is not null"), "sigs")

    bands = _bands(sigs)
    shared = tables.keep(bands.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1"), "shared")
    hits = tables.keep(bands.join(shared, "key"), "hits")
    central = tables.keep(hits.groupBy("rep").agg(F.sum("m").alias("central")), "central")
    most = F.max(F.struct("central", F.xxhash64("rep").alias("x"), F.col("rep").alias("leader")))
    drawn = F.min(F.struct(F.xxhash64("rep", F.col("band") % 4).alias("x"), F.col("rep").alias("leader")))
    leaders = hits.join(central, "rep").groupBy("key").agg(most.alias("most"), drawn.alias("drawn"))
    leaders = tables.keep(leaders.select("key", F.array_distinct(F.array("most.leader", "drawn.leader")).alias("leaders")), "leaders")
    wanted = classes.join(central, "rep", "left_semi").select("doc_id", "h", "rep")
    texts = docs.filter("doc_id is not null").join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h"])
    texts = tables.keep(with_fine(texts.select("rep", F.col("text").alias("body"))), "texts")

    def sig(name: str) -> DataFrame:
        return sigs.select(F.col("rep").alias(name), "way", F.col("n").alias(f"n{name}"), F.col("sig").alias(f"s{name}"))

    stars = hits.join(leaders, "key").select(F.col("rep").alias("a"), "way", F.explode("leaders").alias("b")).filter("a <> b")
    stars = stars.groupBy("a", "b").agg(F.min("way").alias("way"))
    stars = stars.join(sig("a"), ["a", "way"]).join(sig("b"), ["b", "way"])
    stars = tables.keep(estimates(stars.filter(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))), "stars")
    comps = spark.createDataFrame([], "node long, component long")
    many = sets.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    many = tables.keep(many, "many")  # ids with more than a row
    links = tables.keep(bridges(usable, classes, many), "links")
    while True:
        if links.limit(1).count():
            comps = absorb(comps, links, tables)
        apart = named(stars, comps, "a", "b").filter("ca <> cb").select("a", "b", "est")
        best = tables.keep(apart.groupBy("a").agg(F.max_by("b", F.struct("est", "b")).alias("b")), "best")
        links = tables.keep(confirmed(best, texts), "links")
        if links.count() <= LEAST_JOINED * best.count():
            break
        stars = tables.keep(apart.join(best, ["a", "b"], "left_anti"), "stars")
    comps = absorb(comps, links, tables)

    now = hits.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("key", "band", "way", "rep", F.coalesce("component", "rep").alias("comp"))
    now = tables.keep(now, "now")
    count = now.groupBy("key", "comp").agg(F.count("*").alias("c"))
    mixed = count.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("home"), F.sum("c").alias("m"), F.max("c").alias("most")).filter("m > most")
    blocks_of = lambda n: F.ceil(n / BLOCK).cast("int")
    mixed = tables.keep(mixed.select("key", "home", blocks_of(F.col("m") - F.col("most")).alias("ns"), blocks_of(F.col("m")).alias("nt")), "mixed")
    member = now.join(mixed, "key").join(sigs, ["rep", "way"]).join(texts.select("rep", "fine"), "rep").withColumn("seeks", F.col("comp") != F.col("home"))
    fields = F.struct("rep", "comp", "n", "sig", "fine", "seeks")
    seekers = member.filter("seeks").select("key", "band", "way", F.pmod(F.xxhash64("rep"), "ns").alias("s"), F.explode(F.sequence(F.lit(0), F.col("nt") - 1)).alias("t"), fields.alias("seeker"), F.lit(None).alias("other"))
    others = member.select("key", "band", "way", F.explode(F.sequence(F.lit(0), F.col("ns") - 1)).alias("s"), F.pmod(F.xxhash64("rep"), "nt").alias("t"), F.lit(None).alias("seeker"), fields.alias("other"))
    blocks = seekers.unionByName(others).groupBy("key", "band", "way", "s", "t").agg(F.collect_list("seeker").alias("seekers"), F.collect_list("other").alias("others"))
    pairs = block_pairs(blocks).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    comps = absorb(comps, confirmed(tables.keep(pairs, "pairs"), texts), tables)

    members = comps.select(F.col("node").alias("rep"), "component").join(classes.select("rep", "doc_id"), "rep")
    least = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = classes.join(members.select("rep", "component").join(least, "component").drop("component"), "rep", "left")
    full = tables.keep(full.select("digest", F.coalesce("component_id", "doc_id").alias("c"), "n_class"), "full")
    # a row without shingles is where other rows of its id are
    wordless = sets.filter("digest is null").select("doc_id", "n_shingles")
    shared = usable.select("doc_id", "digest").join(wordless.join(many, "doc_id", "left_semi").select("doc_id"), "doc_id", "left_semi")
    elsewhere = tables.keep(shared.join(full, "digest").groupBy("doc_id").agg(F.min("c").alias("c")), "elsewhere")
    tables.drop(keep=("sets", "full", "elsewhere"))
    out = sets.filter("digest is not null").select("doc_id", "n_shingles", "digest").join(full, "digest", "left").select("doc_id", "n_shingles", "c", "n_class")
    out = out.unionByName(wordless.join(elsewhere, "doc_id", "left").withColumn("n_class", F.lit(1).cast("long")))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id"), F.coalesce("n_class", F.lit(1)).alias("n_class"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that near_duplicates keeps, and of rows with the same doc_id one: that with the least hash of its text.

    Rows without a doc_id are in no group, and stay; so do null and empty texts. Very long texts are compared whole. Columns of any type are kept, those
    without an order, such as maps, as well; an empty table stays empty.
    """
    tables = Scratch(docs.sparkSession)
    columns, i = [quoted(c) for c in docs.columns], quoted(doc_id).cast("long")
    gone, twice = apart(["gone", "twice"], docs.columns)
    surplus = tables.keep(near_duplicates(docs, doc_id, text).filter(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct(), "surplus")
    many = tables.keep(docs.filter(i.isNotNull()).groupBy(i.alias(twice)).agg(F.count("*").alias("rows")).filter("rows > 1").select(twice), "many")
    kept = docs.join(surplus, i == F.col(gone), "left_anti")
    once = kept.join(many, i == F.col(twice), "left_anti").select(*columns)
    again = kept.join(many, i == F.col(twice), "left_semi")
    row = F.struct(*columns)
    order = F.struct(F.xxhash64(quoted(text)), F.xxhash64(F.to_json(row)))  # some columns, such as maps, have no order
    again = again.groupBy(i.alias("_id")).agg(F.min_by(row, order).alias("_one")).select("_one.*")
    return once.unionByName(again)


def op10_hyper_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("n_class")


OP10_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w
), e AS MATERIALIZED (
    SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s
), links AS MATERIALIZED (
    SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
), pairs AS MATERIALIZED (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach(doc_id, seen) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.v FROM reach r JOIN pairs b ON r.seen = b.u
), c AS (
    SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id
)
SELECT s.doc_id, len(s.s) AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept FROM s JOIN c USING (doc_id)
"""
