"""Mixing to target weights with soft membership, in DataFrame functions only.

A classifier fitted on the labelled table predicts for every document the posterior of each domain; a document's
tokens count for the domains in these parts. Rates (how often to take a document; 1 as it is) are fitted by projected
gradient on least squares: the expected tokens of the domains, sum of rate * tokens * posterior, are to match the
targets, with rates not negative.

A step moves all documents of the same posteriors alike. So the steps are fitted on the sums of the documents whose posteriors are the same but for
1 / GRID (one pass over the documents, then sums over as many rows as there are such cells), and the documents
then take the same steps with their own posteriors. The sums that their rates give are counted, and returned beside them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, apart, drawn_by_hash, one_text, quoted, table

EVIDENCE = 30.0
#: Cells between 0 and 1 of a posterior. The cells of three domains are 33153 at most.
GRID = 256
#: Domains of the labels table, and the parts of the tokens that they are to have.
TARGETS = {"good": 0.93, "toxic": 0.03, "low": 0.04}


@dataclass(frozen=True)
class Settings:
    """rows: hashed words. most_per_domain: training documents of a domain at most, by hash of their ids. least_z: see word_odds.

    steps, tolerance: of the descent; it ends when no domain is further from its target than this part of all tokens. refresh: steps after
    which the rates of the cells are written out, so that the plan stays short.
    """

    rows: int = 1 << 16
    most_per_domain: int = 1500
    least_z: float = 4.0
    steps: int = 100
    tolerance: float = 1e-4
    refresh: int = 8


def tokens(text: Column) -> Column:
    """Runs of letters and digits, and runs of other signs but spaces."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"), F.lit(0))


def rows_of(text: Column, rows: int) -> Column:
    return F.transform(tokens(text), lambda w: F.pmod(F.xxhash64(w), F.lit(rows)).cast("int"))


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): low for low quality, else toxic or good. Of labels that disagree the first of low, toxic, good counts."""
    domain = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic").when((F.col("quality") == 1) & (F.col("toxic") == 0), "good")
    rank = F.array_position(F.array(*map(F.lit, ("low", "toxic", "good"))), domain)
    known = labels.select("doc_id", domain.alias("domain"), rank.alias("rank")).filter("doc_id is not null and domain is not null")
    return known.groupBy("doc_id").agg(F.min_by("domain", "rank").alias("domain"))


@dataclass(frozen=True)
class Membership:
    """odds [domain, row]: log odds of a word against the first domain; links [domain, 1 + evidence]: from the sums of odds to logits."""

    domains: tuple[str, ...]
    odds: np.ndarray
    links: np.ndarray


def word_odds(seen: np.ndarray, least_z: float) -> np.ndarray:
    """Log odds of rows against the first domain, from seen [domain, row], the documents of a domain that hold a row; 0 where the shares differ by less than least_z errors."""
    of = seen.sum(1, keepdims=True)
    odds = np.log((seen + 0.5) / (of + 1))
    share, both = seen / np.maximum(of, 1), (seen + seen[0]) / np.maximum(of + of[0], 1)
    error = np.sqrt(both * (1 - both) * (1 / np.maximum(of, 1) + 1 / np.maximum(of[0], 1)))
    return np.where((np.abs(share - share[0]) <= least_z * error) | (of == 0), 0, odds - odds[0])


def fit_links(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 1e-3, steps: int = 2000, rate: float = 0.05) -> np.ndarray:
    """Softmax regression of domains y on evidence x [document, evidence], weighted to the share of each domain; Adam, full batch."""
    domains = len(share)
    w = np.zeros((domains, x.shape[1] + 1))
    w[:, 0] = np.log(np.maximum(share, 1e-9))
    if not len(y):
        return w
    x = np.hstack([np.ones((len(x), 1)), x])
    weight = (share / np.maximum(np.bincount(y, minlength=domains), 1))[y]
    weight = weight / weight.sum()
    m, v = np.zeros_like(w), np.zeros_like(w)
    for i in range(1, steps + 1):
        z = x @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        g = (p * weight[:, None]).T @ x
        g[:, 1:] += ridge * w[:, 1:]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    return w


def fit_membership(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], s: Settings = Settings()) -> Membership:
    """Fits on those of labelled(doc_id, domain) that are in docs; of several texts of an id, on the one with the least hash.

    What comes to the driver is bounded: domains * rows counts, and the evidence of the drawn documents.
    """
    tables = Scratch(docs.sparkSession)
    labelled = tables.keep(labelled.join(docs.select("doc_id"), "doc_id", "left_semi"), "present")
    sizes = dict(labelled.groupBy("domain").count().collect())
    drawn = drawn_by_hash(labelled, "domain", dict.fromkeys(domains, s.most_per_domain))  # domains * most_per_domain rows at most
    known = one_text(docs.join(F.broadcast(drawn.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(drawn), "doc_id")
    known = tables.keep(known.select("doc_id", "domain", F.array_distinct(rows_of(F.col("text"), s.rows)).alias("rows")), "labelled")
    seen = np.zeros((len(domains), s.rows))
    for r in known.select("domain", F.explode("rows").alias("row")).groupBy("domain", "row").count().collect():
        seen[domains.index(r["domain"]), r["row"]] = r["count"]
    odds = word_odds(seen, s.least_z)
    rows = known.select("doc_id", "domain", *evidence(odds)).collect()
    x = np.array([r[2:] for r in sorted(rows)], float).reshape(-1, len(domains) - 1)
    y = np.array([domains.index(r["domain"]) for r in sorted(rows)], np.int64)
    tables.drop()
    share = np.array([sizes.get(d, 0) for d in domains], float) / max(1, sum(sizes.get(d, 0) for d in domains))
    if not share.any():
        share[:] = 1 / len(domains)
    return Membership(domains, odds, fit_links(x, y, share))


def _constant(values: np.ndarray) -> Column:
    """An array of doubles in the plan; it folds to one literal."""
    return F.split(F.lit(",".join(f"{x:.6g}" for x in values)), ",").cast("array<double>")


def evidence(odds: np.ndarray, rows: str = "rows") -> list[Column]:
    """For each domain but the first, the sum of the log odds of the distinct words, between -EVIDENCE and EVIDENCE."""
    out = []
    for i, w in enumerate(odds[1:], 1):
        of_row = _constant(w)
        total = F.aggregate(rows, F.lit(0.0), lambda a, r: a + F.get(of_row, r))  # noqa: B023 (called at once)
        out.append(F.greatest(F.lit(-EVIDENCE), F.least(F.lit(EVIDENCE), total)).alias(f"x{i}"))
    return out


def _members(docs: DataFrame, model: Membership, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns in keep as k0, k1, ..., then n (tokens) and the posteriors as p0, p1, ... A text without tokens has no evidence."""
    kept, n = [f"k{i}" for i in range(len(keep))], len(model.domains)
    df = docs.select(*[quoted(c).alias(k) for k, c in zip(kept, keep, strict=True)], rows_of(quoted(text), model.odds.shape[1]).alias("rows"))
    df = df.select(*kept, F.size("rows").cast("long").alias("n"), F.array_distinct("rows").alias("rows"))
    df = df.select(*kept, "n", *evidence(model.odds))
    for i, w in enumerate(model.links.tolist()):
        df = df.withColumn(f"l{i}", sum((F.col(f"x{k}") * c for k, c in enumerate(w[1:], 1)), F.lit(w[0])))
    top = F.greatest(*[F.col(f"l{i}") for i in range(n)]) if n > 1 else F.col("l0")
    df = df.select(*kept, "n", *[F.exp(F.col(f"l{i}") - top).alias(f"e{i}") for i in range(n)])
    total = sum((F.col(f"e{i}") for i in range(1, n)), F.col("e0"))
    return df.select(*kept, "n", *[(F.col(f"e{i}") / total).alias(f"p{i}") for i in range(n)])


def posteriors(docs: DataFrame, model: Membership, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, n_tokens, p_<domain>...) for each row of docs."""
    names = [f"p_{d}" for d in model.domains]
    df = _members(docs, model, keep)
    columns = [F.col(f"k{i}").alias(c) for i, c in enumerate(apart(keep, ["n_tokens", *names]))]
    return df.select(*columns, F.col("n").alias("n_tokens"), *[F.col(f"p{i}").alias(c) for i, c in enumerate(names)])


def cells(members: DataFrame, domains: int) -> DataFrame:
    """The sums of tokens (n) and of tokens * posterior (t0, t1, ...) of members(n, p0, p1, ...) whose posteriors lie in the same cell."""
    at = [F.round(F.col(f"p{i}") * GRID).cast("int").alias(f"c{i}") for i in range(domains - 1)]
    sums = [F.sum(F.col("n") * F.col(f"p{i}")).alias(f"t{i}") for i in range(domains)]
    return members.filter("n > 0").groupBy(*at).agg(F.sum("n").alias("n"), *sums).drop(*[f"c{i}" for i in range(domains - 1)])


def rate_after(moves: list[list[float]], p: list[Column]) -> Column:
    """The rate after the steps, each a row of moves with a number for each domain, of a document with the posteriors p."""
    if not moves:
        return F.lit(1.0)
    n = len(p)
    flat = F.split(F.lit(" ".join(repr(x) for m in moves for x in m)), " ").cast("array<double>")  # folds to one literal
    move = lambda i: sum((F.get(flat, i * n + k) * c for k, c in enumerate(p)), F.lit(0.0))
    return F.aggregate(F.sequence(F.lit(0), F.lit(len(moves) - 1)), F.lit(1.0), lambda r, i: F.greatest(F.lit(0.0), r - move(i)))


@dataclass(frozen=True)
class Rates:
    """moves: the steps of the descent. shares: what they give on the cells. met: whether that is within the tolerance."""

    moves: list[list[float]]
    shares: list[float]
    met: bool


def fit_rates(cells: DataFrame, goal: list[float], s: Settings = Settings()) -> Rates:
    """Descends on cells(n, t0, t1, ...): gradient steps of 1/2 |shares - goal|^2 in the metric of tokens, so that a document's step doesn't depend on its length.

    Their length is Barzilai and Borwein's; the steps up to the best shares are taken. The total of tokens stays that of the documents. No tokens at all: rates are 1.
    """
    tables, n = Scratch(cells.sparkSession), len(goal)
    state = tables.keep(cells.withColumn("rate", F.lit(1.0)), "cells")
    total, goal = state.agg(F.sum("n")).first()[0] or 0, np.array(goal)
    if not total:
        return Rates([], [0.0] * n, False)
    p = [F.col(f"t{i}") / F.col("n") for i in range(n)]

    def shares(df: DataFrame) -> np.ndarray:
        row = df.agg(*[F.sum(F.col("rate") * F.col(f"t{i}")) for i in range(n)]).first()
        return np.array([x / total for x in row])

    now, step, before, moves, seen = shares(state), 1.0, None, [], []
    for i in range(1, s.steps + 1):
        off = now - goal
        if np.abs(off).max() <= s.tolerance:
            break
        if before is not None:
            change, moved = off - before, step * before
            if abs(change @ before) > 1e-15:
                step = float(min(1e4, max(0.5, -(moved @ before) / (change @ before))))
        moves.append([float(step * o) for o in off])
        state = state.withColumn("rate", F.greatest(F.lit(0.0), F.col("rate") - sum((c * m for c, m in zip(p, moves[-1], strict=True)), F.lit(0.0))))
        if i % s.refresh == 0:
            state = tables.keep(state, "cells")
        seen.append(now)
        now, before = shares(state), off
    seen.append(now)
    best = min(range(len(seen)), key=lambda i: float(((seen[i] - goal) ** 2).sum()))  # steps of this kind can overshoot
    tables.drop()
    return Rates(moves[:best], seen[best].tolist(), bool(np.abs(seen[best] - goal).max() <= s.tolerance))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, s: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keep, n_tokens, p_<domain>..., rate, reached_<domain>..., met) for each row of docs(doc_id, text); labels(doc_id, quality, toxic).

    Targets are parts of all tokens of docs and add up to 1; reached_<domain> is the part of them that the rates of all documents give
    a domain, and met says that no domain is off by more than twice the tolerance. Targets that no rates can meet end at the least squares found.

    Null and empty texts have no tokens and the prior's posteriors. Very long texts count with all their tokens, as one row. Null ids
    have no label and are rated as others; equal texts have equal rates. Repeated rows are rated each; an empty table gives no rows. Other columns
    than those in keep are not read; a kept column that has the name of a result gets an underscore.
    """
    targets = targets or TARGETS
    domains, tables = tuple(targets), Scratch(docs.sparkSession)
    model = fit_membership(docs, domain_of(labels), domains, s)
    members = tables.keep(_members(docs, model, keep), "members")
    rates = fit_rates(cells(members, len(domains)), [targets[d] for d in domains], s)
    p = [F.col(f"p{i}") for i in range(len(domains))]
    rated = members.withColumn("rate", rate_after(rates.moves, p))
    sums = rated.agg(F.sum("n").alias("n"), *[F.sum(F.col("rate") * F.col("n") * c).alias(f"p{i}") for i, c in enumerate(p)]).first()
    reached = [(sums[f"p{i}"] or 0.0) / (sums["n"] or 1) for i in range(len(domains))]
    met = bool(sums["n"]) and all(abs(x - targets[d]) <= 2 * s.tolerance for x, d in zip(reached, domains, strict=True))
    names = ["n_tokens", *(f"p_{d}" for d in domains), "rate", *(f"reached_{d}" for d in domains), "met"]
    columns = [F.col(f"k{i}").alias(c) for i, c in enumerate(apart(keep, names))]
    results = ["n", *p, "rate", *map(F.lit, reached), F.lit(met)]
    return rated.select(*columns, *[(F.col(x) if isinstance(x, str) else x).alias(c) for x, c in zip(results, names, strict=True)])


def op6_soft_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
