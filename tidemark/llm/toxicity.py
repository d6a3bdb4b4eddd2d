"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is its hashed word vector and the mean of the hashed vectors of its character trigrams. The network
reads overlapping windows of words; attention pools the states of a window, and a document's score is that of its
most toxic window. Training is multiple-instance: a document's label goes to its highest window, found anew in each
epoch (in the first ones, to the window with the word that tells most by the training labels).
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, drawn_by_hash, map_texts, one_text, table

WORD_ROWS, CHAR_ROWS = 1 << 14, 1 << 12
STRIP = b".,;:!?\"'()[]{}|*%$#&<>-_"
CACHED_WORDS = 150_000
FOLDS = 5


@dataclass(frozen=True)
class Settings:
    """width, hidden: of word and character vectors, of each direction. window, stride: in words.

    most_toxic, most_other: training documents of each label at most, drawn by hash of their ids, however long they are. most_windows: of a training document that has
    more windows, half of so many are those with the words that tell most, the others are drawn by hash; they are cut on executors, so the driver gets
    (most_toxic + most_other) * most_windows windows at most and no whole text. most_words: telling words at most, the most telling ones. Scoring has no such bounds.
    """

    width: int = 8
    hidden: int = 8
    window: int = 24
    stride: int = 12
    most_toxic: int = 1200
    most_other: int = 2000
    most_windows: int = 64
    most_words: int = 50_000
    epochs: int = 14
    guided: int = 4
    batch: int = 64
    rate: float = 0.02
    seed: int = 11


def words_of(body: bytes | None) -> list[bytes]:
    """Lower-cased words (of any script), with what punctuation they have."""
    body = body or b""
    return (body.lower() if body.isascii() else body.decode("utf-8", "replace").lower().encode()).split()


def bare(words: list[bytes]) -> list[bytes]:
    """Words without the punctuation around them, unless there is nothing else."""
    return [w.strip(STRIP) or w for w in words]


def trigram_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For all words together: the hashed trigrams of ^word$, and where each word's begin."""
    raw = np.frombuffer(b"".join(b"^%b$" % w for w in words), np.uint8).astype(np.uint32)
    n = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    key = raw[:-2] * np.uint32(961748927) + raw[1:-1] * np.uint32(73856093) + raw[2:] * np.uint32(19349663)
    rows = ((key ^ (key >> np.uint32(15))) % np.uint32(CHAR_ROWS)).astype(np.int64)
    end = np.cumsum(n)
    inside = np.ones(len(rows) + 2, bool)
    inside[end - 1] = inside[end - 2] = False  # trigrams that run on into the next word
    return rows[inside[: len(rows)]], np.concatenate([[0], np.cumsum(n - 2)[:-1]])


def word_row(word: bytes) -> int:
    return zlib.crc32(word) % WORD_ROWS


def sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.tanh(x * np.float32(0.5))
    y += 1
    y *= np.float32(0.5)
    return y


class Network:
    """p holds the weights: E, C (word and trigram vectors), for both directions W, U, b of the gates z, r, n, and A, a, v, w, c on top."""

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        d, h = 2 * s.width, s.hidden
        init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.s, self.known = s, {}
        self.p = {"E": rng.normal(0, 0.1, (WORD_ROWS, s.width)).astype(np.float32), "C": rng.normal(0, 0.1, (CHAR_ROWS, s.width)).astype(np.float32)}
        for k in ("f", "b"):
            self.p |= {f"W{k}": init(d, 3 * h), f"U{k}": init(h, 3 * h), f"b{k}": np.zeros(3 * h, np.float32)}
        self.p |= {"A": init(2 * h, h), "a": np.zeros(h, np.float32), "v": init(h), "w": init(2 * h), "c": np.full(1, -1.0, np.float32)}

    def rows_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each bare word its row of E; the rows of C of all in a line, and how many each has. Remembers the words, for training."""
        new = [w for w in words if w not in self.known]
        if new:
            rows, at = trigram_rows(new)
            self.known.update(zip(new, zip(map(word_row, new), np.split(rows, at[1:]), strict=True), strict=True))
        found = [self.known[w] for w in words]
        rows = [x for _, x in found]
        return np.array([r for r, _ in found]), np.concatenate(rows), np.array([len(x) for x in rows])

    def inputs(self, words: list[bytes]) -> np.ndarray:
        """The input vector of each word."""
        words = bare(words)
        rows, at = trigram_rows(words)
        n = np.diff(np.append(at, len(rows)))
        chars = np.add.reduceat(self.p["C"][rows], at, axis=0) / n[:, None]
        return np.hstack([self.p["E"][np.fromiter(map(word_row, words), np.int64, len(words))], chars]).astype(np.float32)

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What an input adds to the gates of each direction."""
        return x @ self.p["Wf"] + self.p["bf"], x @ self.p["Wb"] + self.p["bb"]

    def run(self, g: np.ndarray, mask: np.ndarray, k: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """States [time, window, hidden] of one direction, from its gate inputs [time, window, 3 hidden]; a masked step keeps the state."""
        h, u = self.s.hidden, self.p[f"U{k}"]
        steps, n = g.shape[:2]
        full = mask.all(1)
        state, out, saved = np.zeros((n, h), np.float32), np.empty((steps, n, h), np.float32), []
        for t in range(steps) if k == "f" else range(steps - 1, -1, -1):
            hu = state @ u
            zr = sigmoid(g[t, :, : 2 * h] + hu[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[t, :, 2 * h :] + r * hu[:, 2 * h :])
            if keep:
                saved.append((t, state, z, r, new, hu[:, 2 * h :]))
            move = (1 - z) * (new - state)
            state = state + (move if full[t] else mask[t][:, None] * move)
            out[t] = state
        return out, saved

    def score(self, gf: np.ndarray, gb: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
        """Logits of windows, from gate inputs [time, window, 3 hidden] and mask [time, window]."""
        p = self.p
        (sf, kf), (sb, kb) = self.run(gf, mask, "f", keep), self.run(gb, mask, "b", keep)
        states = np.concatenate([sf, sb], axis=2)
        hid = np.tanh(states @ p["A"] + p["a"])
        e = np.where(mask, hid @ p["v"], -1e9)
        e = np.exp(e - e.max(0))
        alpha = e / e.sum(0)
        pooled = (alpha[:, :, None] * states).sum(0)
        return pooled @ p["w"] + p["c"], (states, hid, alpha, pooled, kf, kb)

    def gradients(self, words: list[list[bytes]], y: np.ndarray) -> tuple[float, dict]:
        """Mean log loss of windows, and the gradient of every weight."""
        p, h, n = self.p, self.s.hidden, len(words)
        flat = bare([w for x in words for w in x])
        fresh = dict.fromkeys(flat)
        number = dict(zip(fresh, range(len(fresh)), strict=True))
        which = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
        fresh = list(fresh)
        lengths = np.array([len(x) for x in words])
        steps = lengths.max()
        row, rows, per = self.rows_of(fresh)
        each = np.hstack([p["E"][row], np.add.reduceat(p["C"][rows], np.cumsum(per) - per, axis=0) / per[:, None]])
        x = each[which].astype(p["E"].dtype)
        win = np.repeat(np.arange(n), lengths)
        pos = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        mask = np.zeros((steps, n), np.float32)
        mask[pos, win] = 1
        grid = np.zeros((steps, n, x.shape[1]), np.float32)
        grid[pos, win] = x
        gf, gb = self.gates(grid)
        logit, (states, hid, alpha, pooled, kf, kb) = self.score(gf, gb, mask > 0, True)
        prob = sigmoid(logit)
        loss = -np.mean(y * np.log(prob + 1e-7) + (1 - y) * np.log(1 - prob + 1e-7))
        d = (prob - y) / n
        g = {"w": pooled.T @ d, "c": np.array([d.sum()])}
        dpool = d[:, None] * p["w"]
        dalpha = (states * dpool).sum(2)
        de = alpha * (dalpha - (alpha * dalpha).sum(0))
        g["v"] = (hid * de[:, :, None]).sum((0, 1))
        dhid = de[:, :, None] * p["v"] * (1 - hid**2)
        g["A"] = np.einsum("tni,tnj->ij", states, dhid)
        g["a"] = dhid.sum((0, 1))
        dstates = alpha[:, :, None] * dpool + dhid @ p["A"].T
        dgrid = np.zeros_like(grid)
        for k, saved, ds in (("f", kf, dstates[:, :, :h]), ("b", kb, dstates[:, :, h:])):
            u, w = p[f"U{k}"], p[f"W{k}"]
            gu, gw, gbias, carry = np.zeros_like(u), np.zeros_like(w), np.zeros(3 * h, np.float32), np.zeros((n, h), np.float32)
            for t, before, z, r, new, hn in reversed(saved):
                total = ds[t] + carry
                m = mask[t][:, None]
                dz = -total * m * (new - before) * z * (1 - z)
                dn = total * m * (1 - z) * (1 - new**2)
                dr = dn * hn * r * (1 - r)
                du = np.hstack([dz, dr, dn * r])
                dg = np.hstack([dz, dr, dn])
                gu += before.T @ du
                gw += grid[t].T @ dg
                gbias += dg.sum(0)
                dgrid[t] += dg @ w.T
                carry = total * (1 - m * (1 - z)) + du @ u.T
            g |= {f"U{k}": gu, f"W{k}": gw, f"b{k}": gbias}
        dx = dgrid[pos, win]
        width = self.s.width
        # a sum for each different word, then for each row that the words hash to
        total = lambda at, v, n: np.stack([np.bincount(at, v[:, j], n) for j in range(v.shape[1])], axis=1)
        dword = total(which, dx, len(fresh))
        g["E"] = total(row, dword[:, :width], WORD_ROWS)
        g["C"] = total(rows, np.repeat(dword[:, width:] / per[:, None], per, axis=0), CHAR_ROWS)
        return float(loss), g


class Numbers(dict):
    """Numbers words as they come; fresh holds those that are new."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class Scorer:
    """Scores texts; keeps the gate inputs of words that it has seen, up to CACHED_WORDS."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.at = Numbers()
        self.gf = self.gb = np.zeros((0, 3 * self.net.s.hidden), np.float32)

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.at) > CACHED_WORDS:
            self.clear()
        ids = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        if self.at.fresh:
            gf, gb = self.net.gates(self.net.inputs(self.at.fresh))
            self.gf, self.gb = np.vstack([self.gf, gf]), np.vstack([self.gb, gb])
            self.at.fresh = []
        return ids

    def documents(self, texts: list[list[bytes]], most: int = 1024) -> list[np.ndarray]:
        """The window logits of each text; an empty text has one window, of no words, whose logit is the bias."""
        s = self.net.s
        many = [x for x in texts if x]
        if not many:
            return [self.net.p["c"] for _ in texts]
        ids = self.ids([w for x in many for w in x])
        size = np.array([len(x) for x in many])
        count = np.maximum(1, -(-(size - s.window) // s.stride) + 1)
        begin = np.cumsum(size) - size
        doc = np.repeat(np.arange(len(many)), count)
        first = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * s.stride + begin[doc]
        last = (begin + size)[doc]
        out = []
        for i in range(0, len(doc), most):
            at = first[None, i : i + most] + np.arange(s.window)[:, None]
            mask = at < last[None, i : i + most]
            row = ids[np.minimum(at, last[None, i : i + most] - 1)]
            out.append(self.net.score(self.gf[row], self.gb[row], mask)[0])
        parts = iter(np.split(np.concatenate(out), np.cumsum(count)[:-1]))
        return [next(parts) if x else self.net.p["c"] for x in texts]


def windows_of(words: list[bytes], s: Settings) -> list[list[bytes]]:
    """All windows of a text, as Scorer cuts them."""
    n = max(1, -(-(len(words) - s.window) // s.stride) + 1)
    return [words[j * s.stride : j * s.stride + s.window] for j in range(n)]


def log_odds(yes: int, no: int, n_yes: int, n_no: int) -> float:
    """Of the label for a word that yes of n_yes documents with it hold, and no of n_no without."""
    return float(np.log((yes + 0.2) / (n_yes + 1)) - np.log((no + 0.2) / (n_no + 1)))


def peak(window: list[bytes], odds: dict[bytes, float]) -> float:
    """The odds of the word of a window that tells most; 0 if none is known."""
    return max((odds.get(w, 0.0) for w in bare(window)), default=0.0)


def chosen(windows: list[list[bytes]], odds: dict[bytes, float], most: int, key: object) -> list[list[bytes]]:
    """Of more than most windows the half of most that tell most (ties: the first), and others drawn by a hash of key and place; in order."""
    if len(windows) <= most:
        return windows
    ranked = sorted(range(len(windows)), key=lambda i: (-peak(windows[i], odds), i))
    half = most // 2
    drawn = sorted(ranked[half:], key=lambda i: (zlib.crc32(b"%s:%d" % (str(key).encode(), i)), i))[: most - half]
    return [windows[i] for i in sorted(ranked[:half] + drawn)]


def telling(texts: list[list[bytes]], y: np.ndarray) -> dict[bytes, float]:
    """Log odds of the label for each word, by the documents that hold it."""
    texts = [bare(x) for x in texts]
    yes, no = Counter(w for x, t in zip(texts, y, strict=True) if t for w in set(x)), Counter(w for x, t in zip(texts, y, strict=True) if not t for w in set(x))
    return {w: log_odds(n, no[w], y.sum(), (1 - y).sum()) for w, n in yes.items() if n >= 3}


def train(texts: list[list[bytes]], y: np.ndarray, s: Settings = Settings()) -> Network:
    """Fits the network to whole texts."""
    return train_windows([windows_of(x, s) for x in texts], y, telling(texts, y), s)


def train_windows(bags: list[list[list[bytes]]], y: np.ndarray, odds: dict[bytes, float], s: Settings = Settings()) -> Network:
    """Fits the network to the windows of each text; with one label alone it returns the untrained one with its bias at that label."""
    net = Network(s)
    keep = [i for i, x in enumerate(bags) if x and x[0]]
    bags, y = [bags[i] for i in keep], y[keep].astype(np.float32)
    if not len(y) or y.min() == y.max():
        net.p["w"][:] = 0
        net.p["c"][:] = 3.0 if len(y) and y[0] else -3.0
        return net
    rng = np.random.default_rng(s.seed)
    ends = np.cumsum([len(x) for x in bags])
    peaks = [np.array([peak(w, odds) for w in x]) if y[i] else None for i, x in enumerate(bags)]
    weight = {k: np.zeros_like(v, dtype=np.float32) for k, v in net.p.items()}
    rate = s.rate
    for epoch in range(s.epochs):
        scored = None if epoch < s.guided else np.split(np.concatenate(Scorer(net).documents([w for x in bags for w in x])), ends[:-1])
        picked, label = [], []
        for i, x in enumerate(bags):
            if scored is not None:
                best = int(scored[i].argmax())
            elif y[i]:
                best = int(rng.choice(np.flatnonzero(peaks[i] == peaks[i].max())))  # one of those with the most telling word
            else:
                best = int(rng.integers(len(x)))
            for j in {best} | (set() if y[i] else {int(rng.integers(len(x)))}):
                picked.append(x[j])
                label.append(y[i])
        label = np.array(label, np.float32)
        order = rng.permutation(len(picked))
        for i in range(0, len(order), s.batch):
            part = order[i : i + s.batch]
            _, g = net.gradients([picked[j] for j in part], label[part])
            for k, v in g.items():
                at = np.flatnonzero(v.any(1)) if k in "EC" else slice(None)  # few rows of the word tables are touched
                weight[k][at] += v[at] ** 2
                net.p[k][at] -= (rate * v[at] / (np.sqrt(weight[k][at]) + 1e-6)).astype(np.float32)
        rate = s.rate * (1 - 0.7 * (epoch + 1) / s.epochs)
    net.known = {}
    return net


def fold(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings) -> tuple[list[list[list[bytes]]], np.ndarray, dict[bytes, float]]:
    """Windows of the texts of the training folds, in the bounds of s, their labels, and the log odds of words.

    Of labels that disagree the toxic one counts; of several texts of an id, the one with the least hash. Null texts are left out.
    """
    tables = Scratch(docs.sparkSession)
    known = labels.filter((fold(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = drawn_by_hash(known, "toxic", {1: s.most_toxic, 0: s.most_other})  # so many rows at most
    texts = one_text(docs.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi"))
    texts = texts.filter("text is not null").join(F.broadcast(drawn), "doc_id").select(F.col("doc_id").cast("long"), "toxic", "text")
    texts = tables.keep(texts.repartition(F.xxhash64("doc_id")), "labelled")
    total = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}  # two rows

    def different(kept: dict, bodies: list[bytes | None]) -> dict:
        return {"toxic": kept["toxic"], "words": [sorted(set(bare(words_of(b)))) for b in bodies]}

    words = map_texts(texts, different, "toxic int, words array<binary>", ["toxic"]).select("toxic", F.explode("words").alias("word"))
    words = words.groupBy("word").agg(F.sum("toxic").alias("yes"), F.sum(1 - F.col("toxic")).alias("no")).filter("yes >= 3")
    counts = words.orderBy(F.desc((F.col("yes") + 0.2) / (F.col("no") + 0.2)), "word").limit(s.most_words).collect()  # so many rows at most
    odds = {bytes(r["word"]): log_odds(r["yes"], r["no"], total.get(1, 0), total.get(0, 0)) for r in counts}

    def cut(kept: dict, bodies: list[bytes | None]) -> dict:
        ids = kept["doc_id"].to_pylist()
        bags = [chosen(windows_of(words_of(b), s), odds, s.most_windows, i) for i, b in zip(ids, bodies, strict=True)]
        return {"doc_id": kept["doc_id"], "toxic": kept["toxic"], "windows": [[b" ".join(w) for w in x] for x in bags]}

    rows = map_texts(texts, cut, "doc_id long, toxic int, windows array<binary>", ["doc_id", "toxic"]).collect()  # bounded by Settings
    tables.drop()
    rows.sort(key=lambda r: r["doc_id"])
    return [[bytes(w).split() for w in r["windows"]] for r in rows], np.array([r["toxic"] for r in rows], np.int64), odds


def score_toxicity(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_windows) for each row of docs(doc_id, text).

    Null and empty texts have one empty window, whose score is the network's bias. A
    null doc_id is not held out. Repeated rows give repeated rows; an empty table gives none; other columns are not
    read. All windows of a text are scored, however long it is; of equal windows it doesn't matter which is the highest.
    """
    scorer = Scorer(net)

    def per_batch(kept: dict, bodies: list[bytes | None]) -> dict:
        best, count = np.empty(len(bodies)), np.empty(len(bodies), np.int64)
        i = 0
        while i < len(bodies):  # as many texts at once as make up some hundred thousand words
            part, size = [], 0
            while i + len(part) < len(bodies) and size < 200_000:
                part.append(words_of(bodies[i + len(part)]))
                size += len(part[-1])
            for j, logits in enumerate(scorer.documents(part)):
                best[i + j], count[i + j] = 1 / (1 + np.exp(-float(logits.max()))), len(logits)
            i += len(part)
        return {"doc_id": kept["doc_id"], "score": pa.array(best), "n_windows": pa.array(count)}

    docs = docs.select(F.col("doc_id").cast("long"), "text")
    out = map_texts(docs, per_batch, "doc_id long, score double, n_windows long", ["doc_id"])
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "n_windows")


def op3_bigru_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, s = table(spark, sf_dir, "documents"), Settings()
    bags, y, odds = training_rows(docs, table(spark, sf_dir, "labels"), s)
    return score_toxicity(docs, train_windows(bags, y, odds, s))
