import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import spelling as S


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def brute(words, ratio=5):
    near = defaultdict(list)
    for a in words:
        near[a] = [b for b in words if one_edit(a, b)]
    form = {}
    for w, n in words.items():
        best = min(((-words[x], x) for x in near[w]), default=None)
        form[w] = best[1] if best and -best[0] >= ratio * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], words.get(form[w]), root(w)) for w, n in words.items()}


def found(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


def vocabulary(rng, n):
    seeds = ["".join(rng.choice("abé") for _ in range(rng.randint(5, 9))) for _ in range(n)]
    out = {}
    for s in seeds:
        for w in (s, s[:3] + "x" + s[3:], s[1:], s[:-1] + "ÿ"):
            out[w] = rng.choice([5, 6, 30, 31, 160, 160, 900])
    return out


@pytest.mark.parametrize("block", [1024, 3])
def test_all_near_words_are_found(spark, block):
    """Also where buckets are cut into many blocks."""
    words = vocabulary(random.Random(3), 150)
    near = {r["word"]: (r["n_near"], -r["best"]["back"], r["best"]["form"]) for r in S.near_words(frame(spark, words), block).collect()}
    want = {}
    for a in words:
        others = sorted((-words[b], b) for b in words if one_edit(a, b))
        if others:
            want[a] = (len(others), -others[0][0], others[0][1])
    assert near == want


def test_groups_equal_brute_force(spark):
    words = vocabulary(random.Random(4), 120)
    assert found(S.group_variants(frame(spark, words))) == brute(words)


def test_chains_and_ties(spark):
    chain = {"aaaaaaaa" + "b" * i: 5 * 5**i for i in range(9)}
    ties = {"qqqqqq": 5, "qqqqqr": 50, "qqqqqe": 50, "qqqqq": 49}
    words = chain | ties
    got = found(S.group_variants(frame(spark, words)))
    assert got == brute(words)
    assert got["aaaaaaaa"][4] == "aaaaaaaabbbbbbbb" and got["qqqqqq"][2] == "qqqqqe"


def test_matrices():
    rng = random.Random(1)
    a = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) for _ in range(60)] + ["\U0001f600a", "\x00a", "a"]
    near, before = S.near_matrix(a, a)
    for i, x in enumerate(a):
        for j, y in enumerate(a):
            same = 0
            while same < min(len(x), len(y)) and x[same] == y[same]:
                same += 1
            assert before[i, j] == same and near[i, j] == one_edit(x, y)
    assert S.near_matrix([], [])[0].shape == (0, 0) and isinstance(near, np.ndarray)


def test_very_long_words(spark):
    a, b = "x" * 60_000, "x" * 30_000 + "y" + "x" * 29_999
    assert found(S.group_variants(frame(spark, {a: 50, b: 5, a + "z": 5}))) == {a: (50, 2, None, None, a), b: (5, 1, a, 50, a), a + "z": (5, 1, a, 50, a)}


def counted(rows):
    total = Counter()
    for i, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            p = h % len(w)
            total[w[:p] + w[p + 1 :] if h % 199 == 0 else w] += 1
    return total


def test_counts_of_odd_rows(spark, odd, odd_rows):
    want = counted([(r[0], r[1]) for r in odd_rows])
    got = dict(S.word_counts(odd, least_chars=1, least_count=1).collect())
    assert got == {w: n for w, n in want.items() if w}
    assert S.group_variants(S.word_counts(odd)).count() == sum(len(w) >= 6 and n >= 5 for w, n in want.items())


def test_empty_tables(spark, none):
    assert S.group_variants(S.word_counts(none)).count() == 0
    with pytest.raises(ValueError):
        S.group_variants(frame(spark, {"a": 1}), ratio=1)


def test_query_equals_plain_code(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    words = {w: n for w, n in counted(rows).items() if len(w) >= 6 and n >= 5}
    assert found(S.op13_prefix_suffix_tiles(spark, sf)) == brute(words)
