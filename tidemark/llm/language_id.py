"""Language identification: a convolutional network over bytes.

A text's UTF-8 bytes (A-Z as a-z) are cut into windows of fixed length. Each byte is embedded, filters of several widths run over
a window, the greatest answer of each filter is kept, and a softmax over these gives the languages' probabilities. The text's probabilities are
the means over all its windows, weighted by their letters. Trained here in numpy by Adam, on windows of labelled texts that are cut where the texts are.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_texts, quoted, table, whole

LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
#: Windows that go through the network at once.
AT_ONCE = 1024
#: Bytes that count as letters: a-z, and all of longer sequences.
LETTERS = np.zeros(256, np.float32)
LETTERS[97:123] = LETTERS[128:] = 1


@dataclass(frozen=True)
class Settings:
    """most_texts: training texts of all languages together at most, in equal parts, drawn by hash of their ids; of each the driver gets up to per_text windows.

    So the driver has most_texts * per_text windows of window bytes at most (1.8 MB), however many and long the texts are.
    """

    most_texts: int = 4800
    per_text: int = 4
    window: int = 96
    embedding: int = 8
    widths: tuple[int, ...] = (2, 3, 5)
    filters: int = 16
    epochs: int = 8
    least_steps: int = 250
    batch: int = 256
    rate: float = 0.004
    shortened: float = 0.3
    decay: float = 1e-4


def windows(body: bytes, size: int) -> np.ndarray:
    """All windows of a text, side by side; the last is filled up with zeros."""
    n = max(1, -(-len(body) // size))
    return np.frombuffer(body.ljust(n * size, b"\0"), np.uint8).reshape(n, size)


@dataclass
class ByteNet:
    """table: a vector for each byte; kernel: [offset and vector, filter], with zeros beyond a filter's width; then softmax weights."""

    table: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    languages: list[str]

    @property
    def width(self) -> int:
        return len(self.kernel) // self.table.shape[1]

    def spread(self, x: np.ndarray) -> np.ndarray:
        """[window, position, offset and vector] of windows of bytes, zeros behind the end."""
        n, size = x.shape
        padded = np.zeros((n, size + self.width - 1), np.uint8)
        padded[:, :size] = x
        v = self.table[padded]
        a, b, c = v.strides
        return np.lib.stride_tricks.as_strided(v, (n, size, self.kernel.shape[0]), (a, b, c), writeable=False)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest answer of each filter in each window, and all answers."""
        n, size = x.shape
        answers = (np.ascontiguousarray(self.spread(x)).reshape(n * size, -1) @ self.kernel).reshape(n, size, -1)
        return answers.max(1), answers

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for i in range(0, len(x), AT_ONCE):
            top, _ = self.pooled(x[i : i + AT_ONCE])
            out[i : i + AT_ONCE] = softmax(np.maximum(top + self.shift, 0) @ self.weights + self.bias)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fresh(languages: list[str], s: Settings, rng: np.random.Generator) -> tuple[ByteNet, np.ndarray]:
    """A network with random weights, and which entries of its kernel are within the filters' widths."""
    inside = np.zeros((max(s.widths), s.embedding, s.filters * len(s.widths)), np.float32)
    for k, w in enumerate(s.widths):
        inside[:w, :, k * s.filters : (k + 1) * s.filters] = 1
    inside = inside.reshape(-1, inside.shape[2])
    draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    kernel = draw(*inside.shape) * inside / np.sqrt(np.maximum(inside.sum(0), 1))
    zero = np.zeros(inside.shape[1], np.float32)
    net = ByteNet(draw(256, s.embedding), kernel, zero, draw(inside.shape[1], len(languages)) * 0.1, np.zeros(len(languages), np.float32), languages)
    return net, inside


def gradients(net: ByteNet, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy of windows x with languages y, and its gradients."""
    n, size = x.shape
    top, answers = net.pooled(x)
    at = answers.argmax(1)
    hidden = np.maximum(top + net.shift, 0)
    p = softmax(hidden @ net.weights + net.bias)
    loss = float(-np.log(np.maximum(p[np.arange(n), y], 1e-12)).mean())
    p[np.arange(n), y] -= 1
    p /= n
    back = (p @ net.weights.T) * (hidden > 0)  # [window, filter]: only where a filter answered most does anything flow back
    e, width = net.table.shape[1], net.width
    padded = np.zeros((n, size + width - 1), np.uint8)
    padded[:, :size] = x
    seen = padded[np.arange(n)[:, None, None], at[:, :, None] + np.arange(width)]  # [window, filter, offset]
    kernel = np.einsum("nf,nfke->kef", back, net.table[seen], optimize=True).reshape(net.kernel.shape)
    flow = back[:, :, None, None] * net.kernel.reshape(width, e, -1).transpose(2, 0, 1)[None]
    flat, flow = seen.ravel(), flow.reshape(-1, e)
    vectors = np.stack([np.bincount(flat, flow[:, k], 256) for k in range(e)], 1)
    return loss, {"weights": hidden.T @ p, "bias": p.sum(0), "shift": back.sum(0), "kernel": kernel, "table": vectors}


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], s: Settings = Settings()) -> ByteNet:
    """Adam over batches of windows; some are shortened, so that short texts are known too. Every language weighs the same."""
    rng = np.random.default_rng(17)
    net, inside = fresh(languages, s, rng)
    if not len(y):
        return net
    count = np.bincount(y, minlength=len(languages))
    chance = (1 / np.maximum(count, 1))[y]
    chance /= chance.sum()
    steps = max(s.least_steps, s.epochs * -(-len(y) // s.batch))
    names = ("weights", "bias", "shift", "kernel", "table")
    m, v = ({k: np.zeros_like(getattr(net, k)) for k in names} for _ in range(2))
    for step in range(1, steps + 1):
        drawn = rng.choice(len(y), s.batch, p=chance)
        batch = x[drawn].copy()
        cut = np.where(rng.random(s.batch) < s.shortened, rng.integers(6, s.window + 1, s.batch), s.window)
        batch[np.arange(s.window)[None, :] >= cut[:, None]] = 0
        _, grad = gradients(net, batch, y[drawn])
        grad["kernel"] *= inside
        slow = s.rate * (1 - 0.9 * step / steps)
        for k in names:
            value = getattr(net, k)
            g = (grad[k] + s.decay * value).astype(np.float32)
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            value -= slow * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
    return net


def sample(docs: DataFrame, s: Settings, doc_id: str, text: str, lang: str) -> tuple[list[str], DataFrame]:
    """The languages, and (lang, body) of the texts to learn from. Rows without a text, a language or an id are none of them.

    The first pass reads ids and languages only. Of an id that has several texts in a language the one with the least hash counts.
    """
    rows = docs.select(quoted(doc_id).alias("i"), quoted(lang).cast("string").alias("lang"), quoted(text).cast("string").alias("body"))
    rows = rows.filter("lang is not null and i is not null").withColumn("h", F.xxhash64("i"))
    distinct = dict(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect())  # a row for each language
    languages = sorted(distinct)
    if not languages:
        return [], rows.select("lang", "body").limit(0)
    most = max(1, s.most_texts // len(languages))
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, 1.3 * most / max(1, distinct[k])))])
    near = rows.filter((F.shiftrightunsigned("h", 11) / float(1 << 53) <= share[F.col("lang")]) & F.col("body").isNotNull())
    one = near.groupBy("lang", "h").agg(F.min_by("body", F.struct(F.xxhash64("body"), F.col("body"))).alias("body"))
    ranked = one.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    return languages, ranked.filter(F.col("rank") <= most).select("lang", "h", "body")


def train(docs: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> ByteNet:
    """Fits on the texts of docs that have a language. The driver gets windows, never texts: they are spread evenly over each text."""
    languages, texts = sample(docs, s, doc_id, text, lang)

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        out = []
        for b in bodies:
            x = windows(whole(b).lower(), s.window)
            x = x[LETTERS[x].sum(1) > 0]
            if len(x) > s.per_text:
                x = x[np.linspace(0, len(x) - 1, s.per_text).astype(int)]
            out.append(x.tobytes())
        return kept | {"x": pa.array(out, pa.binary())}

    rows = [] if not languages else sorted(map(tuple, map_texts(texts, per_batch, "lang string, h long, x binary", ["lang", "h"], "body").collect()))
    x = np.frombuffer(b"".join(bytes(r[2]) for r in rows), np.uint8).reshape(-1, s.window)
    y = np.repeat([languages.index(r[0]) for r in rows], [len(r[2]) // s.window for r in rows]).astype(np.int64) if rows else np.zeros(0, np.int64)
    return fit(x, y, languages, s)


def predict(docs: DataFrame, net: ByteNet, keep: list[str] | None = None, text: str = "text", window: int = Settings.window) -> DataFrame:
    """The columns in keep (doc_id) as k0, k1, ..., lang_pred and score for each row of docs, by all windows of its whole text.

    The language is und, with score 0, for a null text, a text without a letter, and if nothing has been learned; else the most probable one,
    of equal ones the first by name, and score is its probability. Equal texts get equal answers, repeated rows give repeated rows, an empty table
    gives none, other columns are not read. Very long texts go through the network by AT_ONCE windows at a time.
    """
    keep = keep or ["doc_id"]
    kinds = docs.select(*map(quoted, keep)).dtypes

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        known = [whole(b).lower() if net.languages and b and LETTER.search(b.decode("utf-8", "replace")) else None for b in bodies]
        names, scores = [UNKNOWN] * len(bodies), np.zeros(len(bodies))
        parts, owner, held = [], [], 0
        sums = np.zeros((len(bodies), max(1, len(net.languages))))

        def flush() -> None:
            if parts:
                x, who = np.concatenate(parts), np.concatenate(owner)
                p = net.probabilities(x) * LETTERS[x].sum(1)[:, None]
                for k in range(p.shape[1]):
                    sums[:, k] += np.bincount(who, p[:, k], len(bodies))
                parts.clear()
                owner.clear()

        for i, b in enumerate(known):
            if b is None:
                continue
            x = windows(b, window)
            for at in range(0, len(x), AT_ONCE):
                parts.append(x[at : at + AT_ONCE])
                owner.append(np.full(len(parts[-1]), i))
                held += len(parts[-1])
                if held >= AT_ONCE:
                    flush()
                    held = 0
        flush()
        for i, b in enumerate(known):
            if b is not None:
                best = int(sums[i].argmax())
                names[i], scores[i] = net.languages[best], min(1.0, sums[i, best] / sums[i].sum())
        return {f"k{i}": kept[c] for i, c in enumerate(keep)} | {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores)}

    schema = ", ".join([f"k{i} {kind}" for i, (_, kind) in enumerate(kinds)] + ["lang_pred string", "score double"])
    return map_texts(docs, per_batch, schema, keep, text)


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that nothing is learned from: checksums of the id modulo 4 that are 2. Rows without an id are not held out, and not learned from either."""
    return F.coalesce(F.crc32(quoted(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op11_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = train(docs.filter(~held_out()))
    out = predict(docs, net)
    return out.select(F.col("k0").alias("doc_id"), held_out("k0").alias("held_out"), "lang_pred", "score")
