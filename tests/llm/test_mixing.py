import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing as M

from .conftest import prose


def descended(n, p, goal, rounds=20_000):
    """Rates of a plain descent on all documents, in short steps."""
    rate, goal = np.ones(len(n)), np.array(goal)
    for _ in range(rounds):
        off = (rate * n) @ p / n.sum() - goal
        if np.abs(off).max() < 1e-5:
            break
        rate = np.maximum(0, rate - 0.5 * p @ off)
    return rate


def test_targets_are_met_with_rates_not_negative(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4, 0.2, 0.3], 400)
    n = rng.integers(0, 500, 400)
    df = spark.createDataFrame([(int(n[i]), *map(float, p[i])) for i in range(400)], "n long, p0 double, p1 double, p2 double")
    goal, s = [0.8, 0.03, 0.17], M.Settings()
    fitted = M.fit_rates(M.cells(df, 3), goal, s)
    assert fitted.met and fitted.shares == pytest.approx(goal, abs=s.tolerance)
    rate = np.array([r.rate for r in df.withColumn("rate", M.rate_after(fitted.moves, [F.col(f"p{i}") for i in range(3)])).collect()])
    assert (rate >= 0).all() and (rate < 0.01).any()
    assert (rate * n) @ p / n.sum() == pytest.approx(goal, abs=2 * s.tolerance)
    plain = descended(n, p, goal)
    assert np.abs((plain * n) @ p / n.sum() - goal).max() < 1e-4
    # both are least squares of 0; of all rates that meet the targets they keep near to what the documents are
    assert np.corrcoef(plain[n > 0], rate[n > 0])[0, 1] > 0.95


def test_unreachable_targets_end(spark):
    df = spark.createDataFrame([(10, 0.5, 0.5), (10, 0.5, 0.5)], "n long, p0 double, p1 double")
    fitted = M.fit_rates(M.cells(df, 2), [1.0, 0.0], M.Settings(steps=20))
    assert fitted.shares[0] == pytest.approx(fitted.shares[1]) and not fitted.met
    none = M.fit_rates(M.cells(df.withColumn("n", F.lit(0).cast("long")), 2), [1.0, 0.0])
    assert (none.moves, none.shares, none.met) == ([], [0.0, 0.0], False)
    assert [r[0] for r in df.select(M.rate_after([], [F.col("p0"), F.col("p1")])).collect()] == [1.0, 1.0]


def test_end_to_end_against_a_plain_version(spark):
    """Posteriors from the fitted weights and the rates of a plain descent, in numpy and Python over the same texts."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(150):
        rows.append((i, prose(rng, rng.randint(5, 60)) + ("", " vile scumword", " $$$ %%% !!")[i % 3]))
        if i < 120:
            labels.append((i, int(i % 3 != 2), int(i % 3 == 1)))
    docs, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    targets = {"good": 0.5, "toxic": 0.2, "low": 0.3}
    got = {r.doc_id: r for r in M.mix(docs, marked, targets).collect()}
    model = M.fit_membership(docs, M.domain_of(marked), tuple(targets))
    hashed = {r.doc_id: r.rows for r in docs.select("doc_id", M.rows_of(F.col("text"), M.Settings().rows).alias("rows")).collect()}
    n = np.array([len(hashed[i]) for i in range(150)])
    x = np.array([[1.0, *(np.clip(model.odds[d][sorted(set(hashed[i]))].sum(), -M.EVIDENCE, M.EVIDENCE) for d in (1, 2))] for i in range(150)])
    z = np.exp(x @ model.links.T)
    p = z / z.sum(1, keepdims=True)
    assert p == pytest.approx(np.array([[got[i][f"p_{d}"] for d in targets] for i in range(150)]), abs=1e-4)
    assert n.tolist() == [got[i].n_tokens for i in range(150)]
    rate = np.array([got[i].rate for i in range(150)])
    reached = (rate * n) @ p / n.sum()
    assert reached == pytest.approx([got[0][f"reached_{d}"] for d in targets], abs=1e-4) and got[0].met
    assert reached == pytest.approx(list(targets.values()), abs=2e-4)
    plain = descended(n, p, list(targets.values()))
    assert np.abs(plain - rate).max() < 0.1


def test_posteriors_tell_domains(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        kind = i % 3
        text = prose(rng, rng.randint(20, 80)) + ("" if kind == 0 else " vile scumword" if kind == 1 else " $$$ %%% !!")
        rows.append((i, text))
        if i < 150:
            labels.append((i, int(kind != 2), int(kind == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in M.mix(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), {"good": 0.6, "toxic": 0.1, "low": 0.3}).collect()}
    p = np.array([[got[i].p_good, got[i].p_toxic, got[i].p_low] for i in range(240)])
    assert p.sum(1) == pytest.approx(1) and (p[150:].argmax(1) == np.arange(150, 240) % 3).mean() > 0.95
    w = np.array([got[i].rate * got[i].n_tokens for i in range(240)])
    assert w @ p / sum(got[i].n_tokens for i in range(240)) == pytest.approx([0.6, 0.1, 0.3], abs=1e-3)


def test_evidence_is_the_sum_over_distinct_words(spark):
    odds = np.random.default_rng(3).normal(size=(3, 64))
    texts = ["a b a $$ c", "", None, "Ä-b 1.5"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select(M.rows_of(F.col("text"), 64).alias("rows")).select("rows", *M.evidence(odds, "rows")).collect()
    assert [len(r.rows) for r in rows] == [5, 0, 0, 6]
    distinct = df.select(F.array_distinct(M.rows_of(F.col("text"), 64)).alias("rows")).select("rows", *M.evidence(odds)).collect()
    for r in distinct:
        assert (r.x1, r.x2) == pytest.approx((odds[1][r.rows].sum(), odds[2][r.rows].sum()), abs=1e-4)


def test_odd_rows(spark, odd, none, labels):
    out = M.mix(odd, labels, keep=("doc_id", "k0"))
    rows = out.collect()
    assert len(rows) == odd.count() and all(r.n_tokens == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert all(r.p_good + r.p_toxic + r.p_low == pytest.approx(1) for r in rows)
    assert M.mix(none, labels).count() == 0
    clash = odd.withColumnsRenamed({"k0": "rate", "seed": "x1", "rows": "l0", "h": "p_good"})
    keep = ("doc_id", "rate", "x1", "l0", "p_good")
    assert M.mix(clash, labels, keep=keep).columns[:5] == ["doc_id", "rate_", "x1", "l0", "p_good_"]
    twice = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, M.domain_of(twice).collect())) == [(1, "low"), (2, "toxic")]


def test_labels_of_documents_that_are_not_there_count_for_nothing(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, prose(rng, 30) + ("" if i % 3 == 0 else " vile scumword" if i % 3 == 1 else " $$$ %%% !!")) for i in range(90)], "doc_id long, text string")
    there = [(i, "abc"[i % 3]) for i in range(90) if i % 3 < 2 or i < 12]
    gone = [(i, "c") for i in range(1000, 1400)]
    s = M.Settings(most_per_domain=40)
    fit = lambda rows: M.fit_membership(docs, spark.createDataFrame(rows, "doc_id long, domain string"), ("a", "b", "c"), s)
    want, got = fit(there), fit(there + gone)
    assert got.odds == pytest.approx(want.odds) and got.links == pytest.approx(want.links) and (want.odds[2] != 0).any()
