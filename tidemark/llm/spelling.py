"""Spelling variant grouping: dense prefix-suffix tiling.

Words that are one edit apart are found in dense tiles: the code points of two blocks of words are laid out as padded
matrices, from the left and from the right, and every pair of the tile gets the length of its common prefix and of its
common suffix. If these reach the longer length less one, and the lengths are at most one apart, a single insertion, deletion or replacement lies between.

Only words that can be so near meet in a tile. With h = l // 2 of the shorter word's length l, the edit lies behind the
first h code points or before the last l - h of them, so a pair agrees in its prefix of h or in its suffix of l - h. A word
goes to the buckets of both pieces, for its own length as the shorter and as the longer one. A large bucket is cut into
blocks by hash, and each pair of its blocks is a tile of its own. Small buckets share a tile. A tile returns a row for each
word, with the number of near words and the best of them, never a row for each pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, quoted, table, whole
from .turn_repair import CRC_TABLE_SQL, crc_sql

#: Fixed values of the contract: bytes of runs of A-Z, a-z and U+00C0 to U+00FF after A-Z have been lower-cased, and one damaged occurrence in so many.
RUN, ONE_IN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++"), 199
LEAST_CHARS, LEAST_COUNT, RATIO = 6, 5, 5
#: Code points of a block's matrix at most, words of a block at most, words that go into a shared tile, distinct words that a task gathers before it passes them on.
BLOCK_POINTS, BLOCK_WORDS, SHARED_WORDS, GATHERED = 1 << 18, 1024, 192, 200_000
NEAR_SCHEMA = "word string, n_near long, best struct<back: long, form: string>"


def damaged(run: bytes, start: int) -> bytes:
    """run without one code point if the checksum of '<doc_id>:<run>' says so; start is the checksum up to the colon."""
    h = zlib.crc32(run, start)
    if h % ONE_IN:
        return run
    s = run.decode()
    at = h % len(s)
    return (s[:at] + s[at + 1 :]).encode()


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of all texts, each text whole, that are long and frequent enough, after the damage.

    A null text has none, a null id counts as an empty one. Repeated rows count each; other columns are not read. A task adds up
    its own words first, so a common word crosses the network once a task and not once a row.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(quoted(doc_id).cast("string").alias("i"), quoted(text).cast("binary").alias("body")).filter("body is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(w, n) for w, n in total.items() if len(w) >= least_chars and (w.isascii() or len(w.decode()) >= least_chars)]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                start = zlib.crc32(f"{i or ''}:".encode())
                for w, n in Counter(RUN.findall(whole(body).lower())).items():
                    if len(w) >= least_chars:
                        total[damaged(w, start)] += n
                if len(total) > GATHERED:
                    yield rows()
        yield rows()

    counted = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def points(words: list[str], right: bool, pad: int) -> np.ndarray:
    """The code points of words as a matrix, a word to a row, padded at the end or (right) at the start."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = int(lengths.max(initial=0))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.arange(width)[None, :]
    inside = at >= (width - lengths)[:, None] if right else at < lengths[:, None]
    out = np.full((len(words), width), pad, np.uint32)
    out[inside] = flat
    return out


def common_length(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For all pairs of rows, how many columns agree from the first on."""
    same = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.int32)
    for k in range(min(a.shape[1], b.shape[1])):
        same &= a[:, k, None] == b[None, :, k]
        if not same.any():
            break
        out += same
    return out


def near_matrix(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of two blocks: whether exactly one edit lies between them, and the length of the common prefix."""
    la, lb = (np.fromiter(map(len, x), np.int32, len(x)) for x in (a, b))
    # pads differ from each other and from all code points, so that no prefix or suffix grows into them
    before = common_length(points(a, False, 0x110000), points(b, False, 0x110001))
    behind = common_length(points(a, True, 0x110000)[:, ::-1], points(b, True, 0x110001)[:, ::-1])
    longer, shorter = np.maximum(la[:, None], lb[None, :]), np.minimum(la[:, None], lb[None, :])
    equal = (before == longer) & (longer == shorter)
    return (before + behind >= longer - 1) & (longer - shorter <= 1) & ~equal, before


class Tiles:
    """Gathers what tiles find: for each word that has near ones their number and the best, by count, then by code points."""

    def __init__(self):
        self.word, self.n_near, self.back, self.form = [], [], [], []

    def note(self, words: list[str], others: list[tuple[str, int]], near: np.ndarray) -> None:
        """others are in order from the best on, so a row's first hit is its best."""
        count = near.sum(1)
        first = near.argmax(1)
        for i in np.flatnonzero(count):
            self.word.append(words[i])
            self.n_near.append(int(count[i]))
            form, n = others[first[i]]
            self.back.append(-n)
            self.form.append(form)

    def batch(self) -> pa.RecordBatch:
        best = pa.StructArray.from_arrays([pa.array(self.back, pa.int64()), pa.array(self.form, pa.string())], ["back", "form"])
        out = pa.RecordBatch.from_arrays([pa.array(self.word, pa.string()), pa.array(self.n_near, pa.int64()), best], ["word", "n_near", "best"])
        self.__init__()
        return out

    def compare(self, a: list[tuple], b: list[tuple] | None) -> None:
        """Tile of a and b, or of a with itself. Members are (bucket, length of the shorter, is it a suffix, word, n)."""
        a = sorted(a, key=lambda m: (-m[4], m[3]))
        other = a if b is None else sorted(b, key=lambda m: (-m[4], m[3]))
        words, others = [m[3] for m in a], [m[3] for m in other]
        near, before = near_matrix(words, others)
        of = lambda ms, k: np.fromiter((m[k] for m in ms), np.int64, len(ms))
        short = of(a, 1)[:, None]
        lengths = np.minimum(np.fromiter(map(len, words), np.int64, len(a))[:, None], np.fromiter(map(len, others), np.int64, len(other))[None, :])
        near &= (of(a, 0)[:, None] == of(other, 0)[None, :]) & (lengths == short)
        near &= (before >= short // 2) != (of(a, 2)[:, None] == 1)  # a pair that shares both pieces counts with its prefix
        self.note(words, [(m[3], m[4]) for m in other], near)
        if b is not None:
            self.note(others, [(m[3], m[4]) for m in a], near.T)


def _piece(short: Column, side: int) -> Column:
    h = F.floor(short / 2).cast("int")
    return F.substring(F.col("word"), F.lit(1), h) if side == 0 else F.right(F.col("word"), short - h)


def members(words: DataFrame) -> DataFrame:
    """(short, side, piece, word, n): the four buckets of each word. A piece is hashed; that two meet by chance costs a comparison."""
    length = F.char_length("word")
    at = [F.struct((length - less).alias("short"), F.lit(side).alias("side"), F.xxhash64(_piece(length - less, side)).alias("piece")) for less in (0, 1) for side in (0, 1)]
    return words.select("word", "n", F.explode(F.array(*at)).alias("k")).select("k.short", "k.side", "k.piece", "word", "n")


def tiles(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(short, side, piece, lo, hi, block, members): the blocks lo and hi of a bucket as one row, if it has two words or more."""
    keys = ["short", "side", "piece"]
    rows = members(words)
    size = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.lit(BLOCK_POINTS) / (F.col("short") + 1)).cast("int")))
    large = rows.groupBy(*keys).count().filter(F.col("count") > size).select(*keys, F.ceil(F.col("count") / size).cast("int").alias("blocks"))
    cut = rows.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    met = cut.groupBy(*keys, lo, hi).agg(F.collect_list(F.struct("block", "word", "n")).alias("members"))
    return met.filter(F.size("members") > 1)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best): for each of words(word, n), distinct words, that has near ones how many, and the best as (minus its n, word)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, shared, bucket = Tiles(), [], 0

        def flush() -> None:
            if shared:
                found.compare(shared, None)
                shared.clear()

        for batch in batches:
            for t in batch.to_pylist():
                bucket += 1
                split = {k: [(bucket, t["short"], t["side"], m["word"], m["n"]) for m in t["members"] if m["block"] == k] for k in {t["lo"], t["hi"]}}
                a = split[t["lo"]]
                if t["lo"] != t["hi"]:
                    if a and split[t["hi"]]:
                        found.compare(a, split[t["hi"]])
                elif len(a) > SHARED_WORDS // 2 or t["short"] > 64:
                    found.compare(a, None)
                else:
                    if len(shared) + len(a) > SHARED_WORDS:
                        flush()
                    shared.extend(a)
            if len(found.word) > GATHERED // 10:
                yield found.batch()
        flush()
        yield found.batch()

    bounded_batches(words.sparkSession)
    partial = tiles(words, block_words).mapInArrow(run, NEAR_SCHEMA)
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def follow(edges: DataFrame, room: Scratch) -> DataFrame:
    """(word, root): each word of edges(word, form) with the last form that it leads to. Edges must have no circle.

    Each round doubles the steps taken, and none is needed where no form has a form. A form's n is RATIO times its word's, so chains are
    short: under 28 words, whatever the corpus, so at most five rounds.
    """
    roots = edges.select("word", F.col("form").alias("root"))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if roots.join(on, "root", "left_semi").isEmpty():
            return roots
        roots = room.keep(roots.join(on, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")), "roots")


def group_variants(words: DataFrame, ratio: int = RATIO, room: Scratch | None = None) -> DataFrame:
    """One row for each of words(word, n): word, n, n_near, form, form_n, root.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of the largest n, of equal ones
    the first by code points, if that n is ratio times the word's or more; else null. The root is what forms lead to, the word itself without one.
    Words must be distinct and not null; an empty table gives none. Words of any length are compared whole.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 at least, or forms could lead in a circle")
    room = room or Scratch(words.sparkSession)
    words = room.keep(words.select("word", "n"), "words")
    near = near_words(words)
    linked = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.back")).alias("form_n"))
    taken = F.col("form_n") >= ratio * F.col("n")
    linked = room.keep(linked.withColumns({"form": F.when(taken, F.col("form")), "form_n": F.when(taken, F.col("form_n"))}), "linked")
    roots = follow(linked.filter("form is not null").select("word", "form"), room)
    return linked.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op13_prefix_suffix_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    room = Scratch(spark)
    out = group_variants(word_counts(table(spark, sf_dir, "documents")), room=room)
    room.drop(keep=("linked", "roots"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")


#: Near words in SQL by another way: words that agree when a letter is left out or covered.
OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE_SQL}, runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS r FROM documents
), per_doc AS (
    SELECT i, r, count(*) AS n FROM runs WHERE length(r) >= 6 GROUP BY ALL
), hashed AS (
    SELECT r, n, {crc_sql("i || ':' || r")} AS h FROM per_doc, crc
), words AS (
    SELECT CASE WHEN h % 199 = 0 THEN left(r, CAST(h % length(r) AS BIGINT)) || substr(r, CAST(h % length(r) AS BIGINT) + 2) ELSE r END AS word, CAST(sum(n) AS BIGINT) AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), spots AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM words
), cut AS (
    SELECT DISTINCT word, n, left(word, pos - 1) || substr(word, pos + 1) AS rest FROM spots
), links AS (
    SELECT a.word, b.word AS other, b.n FROM spots a JOIN spots b ON a.pos = b.pos AND left(a.word, a.pos - 1) = left(b.word, b.pos - 1) AND substr(a.word, a.pos + 1) = substr(b.word, b.pos + 1) AND a.word <> b.word
    UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON rest = words.word
    UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON rest = words.word
), best AS (
    SELECT word, count(*) AS n_near, list_min(list({{'back': -n, 'form': other}})) AS b FROM links GROUP BY word
), formed AS (
    SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.back >= 5 * words.n THEN b.form END AS form, CASE WHEN -b.back >= 5 * words.n THEN -b.back END AS form_n
    FROM words LEFT JOIN best USING (word)
), led AS (
    SELECT word, word AS root, form FROM formed
    UNION ALL SELECT led.word, formed.word, formed.form FROM led JOIN formed ON led.form = formed.word
)
SELECT f.word, f.form, led.root, f.n, f.n_near, f.form_n FROM formed f JOIN led ON led.word = f.word AND led.form IS NULL
"""
