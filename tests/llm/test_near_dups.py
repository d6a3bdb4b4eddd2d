import random
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import near_dups as N
from tidemark.llm.components import components

from .conftest import prose


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else frozenset([tuple(words)] if words else [])


def plain(rows):
    """doc_id to (n_shingles, component), comparing every pair that shares a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for i in sorted(sets):
        near = {j for s in sets[i] for j in held[s]}
        for j in near:
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            held[s].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, rows):
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = plain(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    return want


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_copies_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "TILE", 3)
    rng = random.Random(7)
    texts = []
    for size in (1, 3, 5, 7, 9, 14, 40, 120, 258, 300, 345, 900):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [edited(rng, base, rng.randint(0, max(1, size // 40))) for _ in range(12)]
    line = "One very common line that a great many have at their head."
    texts += [f"{line} {prose(rng, rng.randint(3, 20))}" for _ in range(60)]
    base = [f"v{rng.randrange(10**6)}" for _ in range(150)]
    texts += [edited(rng, base, rng.randint(1, 9)) for _ in range(150)] + [" ".join(base)] * 40
    rng.shuffle(texts)
    want = check(spark, list(enumerate(texts)))
    assert 100 < len({c for _, c in want.values()}) < len(texts) - 150


@pytest.mark.parametrize("turned", [False, True])
def test_ids_with_several_texts(spark, turned):
    """Every text of an id links it, in whatever order the rows come."""
    rng = random.Random(9)
    text = lambda n: [f"q{rng.randrange(10**6)}" for _ in range(n)]
    a, b, c, d = (text(60) for _ in range(4))
    say = lambda w, *more: " ".join([*w, *more])
    rows = [(1, say(a)), (1, say(b)), (2, say(a, "z")), (3, say(b, "z")), (9, say(c)), (9, say(d)), (8, say(c, "y")), (5, say(d)), (5, say(d)), (7, say(text(60))), (4, "few words"), (6, "few words"), (6, None)]
    rows = rows[::-1] if turned else rows
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()]
    of = {1: 1, 2: 1, 3: 1, 9: 5, 8: 5, 5: 5, 7: 7, 4: 4, 6: 4}
    assert sorted(got) == sorted((i, len(shingle_set(t)), of[i], of[i] == i) for i, t in rows)
    one = N.one_of_each(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, `_hash` string, many long"))
    assert one.columns == ["doc_id", "text", "_hash", "many"] and sorted(r.doc_id for r in one.collect()) == [1, 4, 5, 7]


def test_a_bucket_of_many_that_are_not_links(spark, monkeypatch):
    """Texts that share half of their shingles share buckets, but nothing is joined; a few near copies among them are."""
    monkeypatch.setattr(N, "BLOCK", 64)
    rng = random.Random(12)
    head = [f"h{i}" for i in range(60)]
    texts = [" ".join(head + [f"t{rng.randrange(10**6)}" for _ in range(45)]) for _ in range(300)]
    texts += [t + " end" for t in texts[::40]]
    want = check(spark, list(enumerate(texts)))
    assert len({c for _, c in want.values()}) == 300


def test_table(spark, sf):
    check(spark, [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()])


def test_odd_rows(spark, odd, none):
    assert N.near_duplicates(none).count() == 0
    rows = N.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: r for r in rows}
    assert got[6].component_id == 1 and not got[6].kept and got[1].n_class == 3 and got[1].n_shingles == 1
    kept = N.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, None, None]))
    assert N.one_of_each(none).count() == 0
    assert all(got[i].component_id == i and got[i].n_shingles == 0 for i in (2, 3, 4))
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2


def test_estimates_are_unbiased():
    rng = np.random.default_rng(0)
    for n, shared, sign in ((300, 240, N.signature_small), (20_000, 16_000, N.signature_large), (3, 0, N.signature_small)):
        est = []
        for _ in range(60):
            x = rng.integers(0, 2**64, 2 * n - shared, dtype=np.uint64)
            a, b = (np.frombuffer(sign(np.sort(s)), "<u2") for s in (x[:n], x[n - shared :]))
            per = 1 if sign is N.signature_small else N.REGISTERS
            c = float((N.chance(np.array([n / per])) ** 2).sum()) / 2**N.MANTISSA
            est.append(N.estimate(np.array((a == b)[a > 0].sum()), np.array(((a > 0) | (b > 0)).sum()), np.array(c)))
        assert np.mean(est) == pytest.approx(shared / (2 * n - shared), abs=0.02)


def test_registers_follow_the_order():
    x = np.array([0, 1, 2, 3, 5, 1 << 40, (1 << 40) + (1 << 31), 1 << 63, (1 << 63) + (1 << 62)], np.uint64)
    assert (N.registers(x) > 0).all() and len(set(N.registers(x[1:]).tolist())) == 8


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    n = 60
    links = {"path": [(i, i + 1) for i in range(n)], "star": [(n, i) for i in range(n)], "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(110)], "none": []}[shape]
    rng.shuffle(links)
    parent = {x: x for e in links for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    alone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if x not in alone}


def test_columns_without_an_order(spark):
    """Repeated ids with columns that can't be compared, such as maps, and arrays of them."""
    rows = [(1, "a b c", {"k": 1}, [{"x": 2}]), (1, "a b c", {"k": 1}, [{"x": 2}]), (2, None, None, None), (2, None, {"k": 3}, None), (3, "d", {}, [])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, a array<map<string,int>>")
    kept = N.one_of_each(docs)
    assert kept.schema == docs.schema or kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3]
