"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade >= k) = sigmoid(score - threshold_k): one weight vector over hashed text features shared by all grades, and
ordered thresholds. Features are the shares of hashed byte trigrams and a few hashed marks of a text's make-up. A text gets its
expected grade and the tail probability of each grade.

Grades here come from the labels table: 0 for low quality, 1 for good but toxic, 2 for good.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, drawn_by_hash, map_texts, one_text, quoted, table

ROWS = 1 << 12
GRADES = 3


@dataclass(frozen=True)
class Settings:
    """most_per_grade: training documents of a grade at most, drawn by hash of their ids; the driver gets up to ROWS features of each, whatever its length.

    Their likelihoods are weighted by the share of the grade among all labels, so the sample's balance doesn't show.
    """

    most_per_grade: int = 1200
    ridge: float = 1e-3
    steps: int = 250
    rate: float = 0.02


def marks(body: bytes) -> list[int]:
    """Hashed rows of a text's make-up: coarse shares of distinct words, capitals, symbols, digits; word length; lines twice there."""
    words = body.split()
    n, size = max(1, len(words)), max(1, len(body))
    lines = [x for x in body.split(b"\n") if x.strip()]
    values = {
        "distinct": int(10 * len(set(words)) / n) if len(words) >= 20 else 99,
        "capitals": int(10 * len(re.findall(rb"[A-Z]", body)) / size),
        "symbols": min(9, int(50 * (size - len(body.translate(None, b"#*$%&|<>!@^~=_{}[]\\/"))) / size)),
        "digits": min(9, int(20 * (size - len(body.translate(None, b"0123456789"))) / size)),
        "length": min(15, size // n),
        "lines": int(10 * len(set(lines)) / max(1, len(lines))) if len(lines) >= 4 else 99,
        "words": min(12, len(words).bit_length()),
    }
    return [zlib.crc32(f"{k}={v}".encode()) % ROWS for k, v in values.items()]


def trigrams(body: bytes) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8).astype(np.uint32)
    key = raw[:-2] * np.uint32(961748927) + raw[1:-1] * np.uint32(73856093) + raw[2:] * np.uint32(19349663)
    return (key ^ (key >> np.uint32(15))) & np.uint32(ROWS - 1)


def features(body: bytes) -> np.ndarray:
    x = np.zeros(ROWS, np.float32)
    if len(body) >= 3:
        x += np.bincount(trigrams(body), minlength=ROWS) / (len(body) - 2)
    np.add.at(x, marks(body), 1)  # two marks can have the same row
    return x


@dataclass
class Ordinal:
    """weights over the hashed features; thresholds in order, one for each grade above 0."""

    weights: np.ndarray
    thresholds: np.ndarray

    def score(self, body: bytes) -> float:
        s = float(self.weights[marks(body)].sum())
        return s + float(self.weights[trigrams(body)].mean()) if len(body) >= 3 else s

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...: [text, k - 1]."""
        return 1 / (1 + np.exp(-np.clip(np.asarray(score)[:, None] - self.thresholds, -40, 40)))


def gradient(w: np.ndarray, cut: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of grades y, and its gradients by w and by the thresholds cut."""
    z = (x @ w.astype(x.dtype)).astype(float)
    edge = np.concatenate([[-np.inf], cut, [np.inf]])
    upper, lower = (1 / (1 + np.exp(-np.clip(edge[y + k] - z, -40, 40))) for k in (1, 0))
    p = np.maximum(upper - lower, 1e-9)
    du, dl = upper * (1 - upper), lower * (1 - lower)
    gz = weight * (du - dl) / p
    gcut = np.zeros(len(cut) + 2)
    np.add.at(gcut, y + 1, -weight * du / p)
    np.add.at(gcut, y, weight * dl / p)
    return float(-(weight * np.log(p)).sum()), (x.T @ gz.astype(x.dtype)).astype(float), gcut[1:-1]


def column_deviation(x: np.ndarray, at_once: int = 256) -> np.ndarray:
    """x.std(0), some columns at a time."""
    return np.concatenate([x[:, i : i + at_once].std(0) for i in range(0, x.shape[1], at_once)])


def fit(x: np.ndarray, y: np.ndarray, share: np.ndarray, s: Settings = Settings(), own: bool = False) -> Ordinal:
    """Adam on standardised features; the thresholds stay in order, as the first and the logs of the gaps are what moves.

    With own x itself is standardised, and no copy made.
    """
    grades = len(share)
    if not len(y):
        return Ordinal(np.zeros(x.shape[1], np.float32), np.arange(grades - 1) - 2.0)
    mean, deviation = x.mean(0), column_deviation(x)
    spread = deviation + 1e-6 + 0.02 * deviation.max()
    x = np.subtract(x, mean, out=x if own else None)
    x /= spread
    count = np.bincount(y, minlength=grades)
    weight = (share / np.maximum(count, 1))[y]
    weight = weight / weight.sum()
    w, free = np.zeros(x.shape[1]), np.zeros(grades - 1)
    free[0] = -1.0
    m, v = np.zeros(len(w) + len(free)), np.zeros(len(w) + len(free))
    for i in range(1, s.steps + 1):
        cut = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
        _, gw, gc = gradient(w, cut, x, y, weight)
        gfree = np.array([gc.sum(), *(gc[k:].sum() * np.exp(free[k]) for k in range(1, grades - 1))])
        g = np.concatenate([gw + s.ridge * w, gfree])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = s.rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-8)
        w, free = w - step[: len(w)], free - step[len(w) :]
    cut = free[0] + np.concatenate([[0], np.cumsum(np.exp(free[1:]))])
    return Ordinal((w / spread).astype(np.float32), cut + float(w @ (mean / spread)))


def feature_rows(texts: DataFrame) -> DataFrame:
    """(doc_id, at, value) of texts(doc_id, text): the features that are not 0, as packed numbers."""

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        at, value = [], []
        for b in bodies:
            x = features(b or b"")
            rows = np.flatnonzero(x)
            at.append(rows.astype("<u2").tobytes())
            value.append(x[rows].astype("<f4").tobytes())
        return kept | {"at": pa.array(at, pa.binary()), "value": pa.array(value, pa.binary())}

    return map_texts(texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), per_batch, "doc_id long, at binary, value binary", ["doc_id"])


def train(docs: DataFrame, graded: DataFrame, grades: int = GRADES, s: Settings = Settings()) -> Ordinal:
    """Fits on docs(doc_id, text) with graded(doc_id, grade); grades out of 0 .. grades - 1 and nulls are ignored.

    Of grades that disagree the lowest counts; of several texts of an id, the one with the least hash. Features are made where the texts are.
    """
    known = graded.filter(F.col("grade").between(0, grades - 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col("grade").cast("int")).alias("grade"))
    counts = dict(known.groupBy("grade").count().collect())  # a row for each grade
    share = np.array([counts.get(g, 0) for g in range(grades)], float) / max(1, sum(counts.values()))
    drawn = drawn_by_hash(known, "grade", dict.fromkeys(range(grades), s.most_per_grade))  # grades * most_per_grade rows at most
    texts = one_text(docs.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi"))
    rows = sorted(feature_rows(texts).join(F.broadcast(drawn), "doc_id").select("doc_id", "grade", "at", "value").collect())
    x, y = np.zeros((len(rows), ROWS), np.float32), np.array([r["grade"] for r in rows], np.int64)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["value"], "<f4")
    del rows
    return fit(x, y, share, s, own=True)


def _scored(docs: DataFrame, model: Ordinal, keep: list[str]) -> DataFrame:
    """The columns in keep as k0, k1, ..., then the tails as t1, t2, ... of each row."""
    kinds = docs.select(*map(quoted, keep)).dtypes
    tails = [f"t{k + 1}" for k in range(len(model.thresholds))]

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        p = model.tails(np.array([model.score(b or b"") for b in bodies]))
        return {f"k{i}": kept[c] for i, c in enumerate(keep)} | {t: pa.array(p[:, k]) for k, t in enumerate(tails)}

    schema = ", ".join([f"k{i} {kind}" for i, (_, kind) in enumerate(kinds)] + [f"{t} double" for t in tails])
    return map_texts(docs, per_batch, schema, keep)


def score_quality(docs: DataFrame, model: Ordinal, keep: list[str] | None = None) -> DataFrame:
    """Scores every whole text, however long: the columns in keep (doc_id), expected_grade and p_ge_1, p_ge_2, ...

    A kept column that has the name of a result gets an underscore. Null and empty texts are scored by the marks of an empty text;
    a null id stays null; equal texts have equal scores. Repeated rows give repeated rows, an empty table gives none.
    """
    keep, n = keep or ["doc_id"], len(model.thresholds)
    results = ["expected_grade", *(f"p_ge_{k + 1}" for k in range(n))]
    out = _scored(docs, model, keep)
    columns = [F.col(f"k{i}").alias(c) for i, c in enumerate(apart(keep, results))]
    return out.select(*columns, sum(F.col(f"t{k + 1}") for k in range(n)).alias("expected_grade"), *[F.col(f"t{k + 1}").alias(f"p_ge_{k + 1}") for k in range(n)])


def of_quality(docs: DataFrame, model: Ordinal, least_tail: float = 0.5) -> DataFrame:
    """The rows of docs, with their columns as they are, whose probability of a grade over the lowest is least_tail or more."""
    return _scored(docs, model, docs.columns).filter(F.col("t1") >= least_tail).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])


def graded(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))


def op4_cumulative_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, train(docs, graded(table(spark, sf_dir, "labels"))))
    return scored.withColumn("kept", F.col("p_ge_1") >= 0.5)
