import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as T

from .conftest import prose

SMALL = T.Settings(width=2, hidden=3, window=6, stride=4)


def test_gradients_by_differences():
    net = T.Network(SMALL)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, y = [[b"abc", b"de", b"f"], [b"xyz!"], [b"abc", b"xyz"]], np.array([1.0, 0, 1])
    _, g = net.gradients(words, y)
    rng = np.random.default_rng(0)
    for k in net.p:
        at = np.argwhere(np.abs(g[k]) > 0)
        for i in map(tuple, at[rng.permutation(len(at))[:4]]):
            old, e = net.p[k][i], 1e-3
            net.p[k][i] = old + e
            up = net.gradients(words, y)[0]
            net.p[k][i] = old - e
            down = net.gradients(words, y)[0]
            net.p[k][i] = old
            assert (up - down) / (2 * e) == pytest.approx(g[k][i], rel=2e-2, abs=3e-5), (k, i)


def gru(p, xs, k, order):
    """One word after another, by the equations of the gated recurrent unit."""
    h, out = np.zeros(p[f"U{k}"].shape[0]), {}
    n = len(h)
    s = lambda v: 1 / (1 + np.exp(-v))
    for t in order:
        gx, gh = xs[t] @ p[f"W{k}"] + p[f"b{k}"], h @ p[f"U{k}"]
        z, r = s(gx[:n] + gh[:n]), s(gx[n : 2 * n] + gh[n : 2 * n])
        h = z * h + (1 - z) * np.tanh(gx[2 * n :] + r * gh[2 * n :])
        out[t] = h
    return [out[t] for t in range(len(xs))]


def test_against_a_plain_forward_pass():
    net = T.Network(T.Settings(width=3, hidden=4, window=5, stride=2))
    p = {k: v.astype(float) for k, v in net.p.items()}
    words = [b"mud", b"(sot!)", b"g", b"mud", b"\xc3\xa9t\xc3\xa9"]
    xs = []
    for w in words:
        w = w.strip(T.STRIP) or w
        raw = np.frombuffer(b"^" + w + b"$", np.uint8).astype(np.uint32)
        rows = []
        for a, b, c in zip(raw, raw[1:], raw[2:], strict=False):
            key = (int(a) * 961748927 + int(b) * 73856093 + int(c) * 19349663) % 2**32
            rows.append((key ^ (key >> 15)) % T.CHAR_ROWS)
        xs.append(np.concatenate([p["E"][zlib.crc32(w) % T.WORD_ROWS], np.mean([p["C"][r] for r in rows], axis=0)]))
    n = len(words)
    states = [np.concatenate(x) for x in zip(gru(p, xs, "f", range(n)), gru(p, xs, "b", range(n - 1, -1, -1)), strict=True)]
    e = np.array([np.tanh(x @ p["A"] + p["a"]) @ p["v"] for x in states])
    alpha = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
    logit = sum(a * x for a, x in zip(alpha, states, strict=True)) @ p["w"] + p["c"][0]
    assert T.Scorer(net).documents([words])[0][0] == pytest.approx(logit, abs=1e-4)


def test_capitals_of_any_script():
    assert T.words_of("ÉTÉ Über STRASSE".encode()) == ["été".encode(), "über".encode(), b"strasse"] and T.words_of(b"A \xff") == [b"a", "\ufffd".encode()]


def test_windows_of_a_long_training_text():
    words = [b"w%d" % i for i in range(400)]
    words[250] = b"(vilemud),"
    every = T.windows_of(words, SMALL)
    assert T.chosen(every, {}, len(every), 3) == every
    got = T.chosen(every, {b"vilemud": 2.0, b"w9": 1.0}, 8, 3)
    assert len(got) == 8 and sum(words[250] in w for w in got) == sum(words[250] in w for w in every) and any(b"w9" in w for w in got)
    assert got == [w for w in every if w in got] == T.chosen(every, {b"vilemud": 2.0, b"w9": 1.0}, 8, 3) != T.chosen(every, {b"vilemud": 2.0, b"w9": 1.0}, 8, 4)
    assert T.windows_of([], SMALL) == [[]] and T.peak([], {}) == 0.0


def test_windows_cover_every_word():
    net = T.Network(SMALL)
    for n in (1, 5, 6, 7, 10, 11, 100):
        words = [b"w%d" % i for i in range(n)]
        got = T.Scorer(net).documents([words, [], words[:1]])
        starts = range(0, len(got[0]) * SMALL.stride, SMALL.stride)
        assert len(got[0]) == max(1, -(-(n - SMALL.window) // SMALL.stride) + 1) and starts[-1] + SMALL.window >= n
        alone = [T.Scorer(net).documents([words[s : s + SMALL.window]])[0][0] for s in starts]
        assert got[0] == pytest.approx(alone, abs=1e-4)
        assert len(got[1]) == 1


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(600):
        text = prose(rng, rng.randint(5, 120)).split()
        toxic = i % 4 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(("vilemud", "vilesot", "vileg")) + rng.choice(("", ",", "ne")))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_held_out(spark, corpus):
    docs = spark.createDataFrame([r[:2] for r in corpus], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in corpus], "doc_id long, quality int, toxic int")
    s = T.Settings(most_toxic=100, most_other=200)
    bags, y, odds = T.training_rows(docs, labels, s)
    assert y.sum() == 100 and len(bags) == 300
    body = {i: T.words_of(t.encode()) for i, t, _ in corpus}
    drawn = [i for i in body if T.windows_of(body[i], s) in bags]
    assert len(drawn) >= 300 and odds == pytest.approx(T.telling([body[i] for i in drawn], np.array([corpus[i][2] for i in drawn])))
    few = T.training_rows(docs, labels, T.Settings(most_toxic=100, most_other=200, most_windows=2))
    assert max(map(len, few[0])) == 2 and all(any(T.peak(w, odds) > 2 for w in x) for x, t in zip(few[0], few[1], strict=True) if t)
    net = T.train_windows(bags, y, odds, s)
    got = {r.doc_id: r for r in T.score_toxicity(docs, net).collect()}
    held = [i for i, _, _ in corpus if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sorted(i for i, r in got.items() if r.held_out) == held
    assert np.mean([got[i].predicted == corpus[i][2] for i in held]) > 0.9


def test_one_label_alone(spark, odd, none):
    net = T.train([[b"a"]], np.array([0]))
    got = T.score_toxicity(odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r.score < 0.5 and r.predicted == 0 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]
    assert T.score_toxicity(none, net).count() == 0
    assert T.train([], np.zeros(0)).p["c"][0] == -3.0
