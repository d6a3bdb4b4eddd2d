import random
import re

import pytest

from tidemark.llm import decontaminate as D


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain(text, item, seeded=True, most=11):
    """Best stretch over all ways to lay the item along the text without gaps (seeded: where a seed matches, or an item shorter than the masks as a whole)."""
    d, w, best = words(text), words(item), (0, 0)
    masks = D.MASKS + (D.CLOSE if len(w) <= most else ()) if len(w) >= D.SHORTEST else (range(len(w)),)
    for shift in range(-len(w) + 1, len(d)):
        same = [0 <= i + shift < len(d) and d[i + shift] == w[i] for i in range(len(w))]
        lo, hi = max(0, -shift), min(len(w), len(d) - shift)
        if seeded and not any(all(same[i + p] for p in m) for m in masks for i in range(lo, min(hi, len(w)) - m[-1])):
            continue
        run = hits = 0
        for i in range(lo, hi):
            if run < 0:
                run = hits = 0
            run, hits = run + (1 if same[i] else -1), hits + same[i]
            best = max(best, (run, hits))
    return best


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    w = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [w(rng.choice((1, 3, 5, 7, 9, 15, 30))) for _ in range(20)]
    docs = []
    for i in range(160):
        text, kind = w(rng.randint(0, 80)), i % 5
        if kind:
            part = list(items[rng.randrange(20)])
            if kind == 2:
                part = part[: max(1, len(part) // 2)]
            for j in range(len(part)):
                if (kind == 3 and j % 5 == 4) or (kind == 4 and rng.random() < 0.3):
                    part[j] = "other"
            at = rng.randint(0, len(text))
            text = text[:at] + part + text[at:]
        docs.append((i, (", " if i % 2 else " ").join(text).title()))
    return docs, [(i, " ".join(x)) for i, x in enumerate(items)]


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_by_brute_force(spark, corpus, broadcast):
    docs, items = corpus
    limits = D.Limits(least_matches=8, least_score=5, broadcast_seeds=broadcast)
    got = D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), limits)
    want = {}
    for i, text in docs:
        hit = []
        for k, item in items:
            (score, matches), n = plain(text, item, most=9), len(words(item))
            off = n >= 6
            if score >= min(5, n - 2 * off) and matches >= min(8, n - off):
                hit.append(k)
        if hit:
            want[i] = hit
    assert {r.doc_id: r["items"] for r in got.collect()} == want and len(want) > 40


def test_substitutions_are_tolerated(spark):
    item = [f"q{i}" for i in range(20)]
    texts = {k: " ".join("zz" if f(i) else w for i, w in enumerate(item)) for k, f in enumerate((lambda i: False, lambda i: i % 5 == 3, lambda i: i % 3 == 2, lambda i: i % 2, lambda i: i > 8))}
    df = spark.createDataFrame([(k, f"before {t} after") for k, t in texts.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "too short")], "item_id long, text string")
    assert {r.doc_id for r in D.contaminated(df, bench).collect()} == {0, 1, 2}
    loose = D.Limits(least_matches=8, least_score=6)
    assert {r.doc_id for r in D.contaminated(df, bench, loose).collect()} == {0, 1, 2, 4}


def test_short_items_are_found_whole(spark):
    docs = spark.createDataFrame([(1, "say Alpha, beta gamma!"), (2, "alpha x gamma"), (3, "the word here"), (4, "one two three four five six seven eight nine"), (5, "one two three four x SIX seven x nine"), (6, "abc 日本語です xyz")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "alpha beta gamma"), (2, "word"), (3, "one two three four five six seven eight nine"), (4, "日本語です"), (None, "alpha beta gamma")], "item_id long, text string")
    found = lambda limits: {r.doc_id: r["items"] for r in D.contaminated(docs, bench, limits).collect()}
    assert found(D.Limits()) == {1: [1], 3: [2], 4: [3], 6: [4]}
    assert found(D.Limits(least_item=5)) == {4: [3], 6: [4]}


@pytest.mark.parametrize("n", [6, 7, 8, 9, 10, 11])
def test_one_word_of_a_short_item_may_be_another(spark, n):
    item = [f"q{i}" for i in range(n)]
    docs = [(i, " ".join(["before", *item[:i], "zz", *item[i + 1 :], "after"])) for i in range(n)]
    docs += [(100 + i, " ".join(["before", *("zz" if j in (i, i + 1 + i % 2) else w for j, w in enumerate(item)), "after"])) for i in range(1, n - 3)]
    docs += [(200, " ".join(item[2:])), (201, " ".join(item[: n // 2]))]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id for r in D.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == set(range(n))


def test_common_phrases_are_no_leaks(spark):
    docs = spark.createDataFrame([(i, f"the text {i} of the corpus" + (" has a rare phrase" if i == 7 else "")) for i in range(300)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "the"), (2, "of the"), (3, "a rare phrase"), (4, "Text 9 of the corpus")], "item_id long, text string")
    found = lambda limits: {r.doc_id: r["items"] for r in D.contaminated(docs, bench, limits).collect()}
    assert found(D.Limits()) == {7: [3], 9: [4]}
    every = found(D.Limits(common=1.0))
    assert len(every) == 300 and every[7] == [1, 2, 3] and every[9] == [1, 2, 4]


def test_share_of_overlaps_that_have_a_seed():
    """Stretches at the limits (10 matches, score 8) and a little longer, their substitutions at random: 0.95 at least are found."""
    rng = random.Random(5)
    found = total = 0
    for _ in range(3000):
        n, bad = rng.choice(((10, 0), (11, 1), (12, 2), (13, 2), (14, 3), (16, 4), (18, 4), (24, 6), (30, 8)))
        item = [f"i{i}" for i in range(n)]
        text = list(item)
        for i in rng.sample(range(1, n - 1), bad):
            text[i] = "x"
        score, matches = plain(" ".join(text), " ".join(item), seeded=False)
        if score >= 8 and matches >= 10:
            total += 1
            found += plain(" ".join(text), " ".join(item)) >= (8, 10)
    assert total > 1000 and found / total > 0.95


def test_odd_rows(spark, odd, none):
    long = " ".join(odd.filter("doc_id = 5").first().text.split()[5000:5030])
    bench = spark.createDataFrame([(9, long), (9, long), (8, long)], "item_id long, text string")
    got = D.contaminated(odd, bench).collect()
    assert [(r.doc_id, r["items"], r.matches) for r in got] == [(5, [8, 9], 30)]
    clash = odd.withColumnsRenamed({"k0": "_h", "seed": "_g", "rows": "g"})
    assert D.decontaminated(clash, bench).columns == clash.columns
    kept = D.decontaminated(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert D.contaminated(none, bench).count() == 0 and D.decontaminated(odd, bench.limit(0)).count() == odd.count()
