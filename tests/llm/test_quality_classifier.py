import random

import numpy as np
import pytest

from tidemark.llm import quality_classifier as Q

from .conftest import prose


def test_gradient_by_differences():
    rng = np.random.default_rng(1)
    x, y, w, cut = rng.normal(size=(40, 5)), rng.integers(0, 4, 40), rng.normal(size=5), np.array([-1.0, 0.2, 1.5])
    weight = rng.random(40)
    loss, gw, gc = Q.gradient(w, cut, x, y, weight)
    for v, g in ((w, gw), (cut, gc)):
        for i in range(len(v)):
            old = v[i]
            v[i] = old + 1e-5
            up = Q.gradient(w, cut, x, y, weight)[0]
            v[i] = old - 1e-5
            down = Q.gradient(w, cut, x, y, weight)[0]
            v[i] = old
            assert (up - down) / 2e-5 == pytest.approx(g[i], rel=1e-4, abs=1e-6)


def test_grades_are_told_apart(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        g = i % 3
        text = prose(rng, rng.randint(30, 120))
        text = text.upper().replace(" ", "%% ") if g == 0 else text.replace(" ", " zzz ", 12) if g == 1 else text
        rows.append((i, text, g))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    graded = spark.createDataFrame([(i, g) for i, _, g in rows if i % 2] + [(1, None), (None, 1), (3, 9)], "doc_id long, grade int")
    model = Q.train(docs, graded)
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in Q.score_quality(docs, model).collect()}
    held = [r for r in rows if r[0] % 2 == 0]
    assert np.mean([round(got[i].expected_grade) == g for i, _, g in held]) > 0.9
    assert all(r.p_ge_1 >= r.p_ge_2 and r.expected_grade == pytest.approx(r.p_ge_1 + r.p_ge_2) for r in got.values())


def test_a_score_is_the_weighted_features():
    rng = np.random.default_rng(2)
    model = Q.Ordinal(rng.normal(size=Q.ROWS).astype(np.float32), np.array([0.0, 1.0]))
    for body in (b"", b"ab", b"some words AND $$$ more", "é ü".encode()):
        x = Q.features(body)
        assert float(x @ model.weights) == pytest.approx(model.score(body), abs=1e-4)
    model.weights[:] = 1  # marks with the same row count each
    assert all(model.score(b) == pytest.approx(float(Q.features(b) @ model.weights), abs=1e-3) for b in (b"w%d " % i * i for i in range(300)))


def test_long_documents_are_drawn(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 6000) + (" %%" * 3000 if i % 2 else ""), i % 2) for i in range(24)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = Q.train(docs, spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int"), 2)
    got = {r.doc_id: r.p_ge_1 for r in Q.score_quality(docs, model).collect()}
    assert all((got[i] > 0.5) == g for i, _, g in rows)


def test_against_a_plain_likelihood_fit():
    """A slow fit of the same likelihood, gradients by differences, ends at the same thresholds and order of scores."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 3)).astype(np.float32)
    z = x @ np.array([1.5, -1.0, 0.0]) + rng.logistic(size=300)
    y = np.digitize(z, [-1.0, 1.0])
    share = np.bincount(y) / 300
    model = Q.fit(x, y, share, Q.Settings(steps=1500, rate=0.02, ridge=1e-6))

    def loss(v):
        score, cut = x @ v[:3], np.array([-np.inf, v[3], v[3] + np.exp(v[4]), np.inf])
        p = 1 / (1 + np.exp(-(cut[y + 1] - score))) - 1 / (1 + np.exp(-(cut[y] - score)))
        return -np.log(np.maximum(p, 1e-9)).mean()

    v = np.zeros(5)
    for _ in range(1500):
        v -= 0.5 * np.array([(loss(v + e) - loss(v - e)) / 2e-4 for e in 1e-4 * np.eye(5)])
    assert model.weights == pytest.approx(v[:3], abs=0.05) and model.thresholds == pytest.approx([v[3], v[3] + np.exp(v[4])], abs=0.05)


def test_odd_rows(spark, odd, none, labels):
    model = Q.train(odd, Q.graded(labels))
    got = Q.score_quality(odd, model, keep=odd.columns)
    assert got.columns == [*odd.columns, "expected_grade", "p_ge_1", "p_ge_2"] and got.count() == odd.count()
    assert Q.score_quality(none, model).count() == 0
    clash = odd.withColumnsRenamed({"k0": "p_ge_1", "seed": "expected_grade", "rows": "t1", "h": "a.b"})
    named = Q.score_quality(clash, model, keep=clash.columns)
    assert {"p_ge_1_", "expected_grade_", "p_ge_1", "expected_grade", "t1", "a.b"} <= set(named.columns) and named.count() == odd.count()
    assert Q.of_quality(clash, model).columns == clash.columns and Q.of_quality(none, model).count() == 0
    twice = Q.train(odd.unionByName(odd), Q.graded(labels))
    assert twice.score(b"x") == model.score(b"x")
    assert {(r.doc_id, r.text is None) for r in got.collect()} >= {(2, True), (None, True)}
