import random
import re

import numpy as np

from tidemark.llm import substring_dedup as D

from .conftest import prose


def rng_prose(seed, n):
    rng = random.Random(seed)
    return prose(rng, n, ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(5000)])


def test_gear_hash_by_its_definition():
    raw = np.frombuffer(random.Random(2).randbytes(200), np.uint8)
    want = [sum(int(D.GEAR[raw[i - k]]) << k for k in range(min(16, i + 1))) % 2**16 for i in range(200)]
    assert D.gear_hash(raw).tolist() == want


def test_chunks_cover_the_text_and_respect_bounds():
    how = D.Chunking()
    for body in (rng_prose(1, 3000).encode(), ("é" * 4000).encode(), b"a", b"x" * 5000):
        ends = D.boundaries(body, how)
        sizes = np.diff(np.append(0, ends))
        assert ends[-1] == len(body) and (sizes <= how.most + 3).all() and (sizes[:-1] >= how.least).all()
        for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
            body[a:b].decode()


def test_an_insertion_moves_few_chunks():
    text = rng_prose(3, 2000)

    def cut(t):
        ends = D.boundaries(t.encode(), D.Chunking()).tolist()
        return {t.encode()[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)}

    a, b = cut(text), cut(text[:3000] + " something new " + text[3000:])
    assert len(a - b) <= 4


def test_passages_are_found_and_clean_texts_left_alone(spark):
    passages = [rng_prose(100 + i, 55) for i in range(30)]
    docs = [(2 * i + k, f"{rng_prose(1000 + 2 * i + k, 40 + 20 * k)} {p} {rng_prose(5000 + 2 * i + k, 30)}") for i, p in enumerate(passages) for k in (0, 1)]
    line = "A common line of some words that many have.\n"
    docs += [(1000 + i, line + rng_prose(9000 + i, 150)) for i in range(30)]
    got = D.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    found = {r.doc_id for r in got}
    assert not {i for i in found if i >= 1000}
    assert len(found) >= 58
    texts = dict(docs)
    for r in got:
        own = texts[r.doc_id][r.start : r.end]
        assert own in texts[r.doc_id ^ 1]
        assert r.kept_chars + r.dropped_chars == r.end - r.start and (r.kept_chars == 0) == (r.doc_id % 2 == 1)


def test_odd_rows(spark, odd, none):
    assert D.repeated_passages(none).count() == 0
    rows = D.repeated_passages(odd, least_chars=10).collect()
    assert {r.doc_id for r in rows} >= {1, 6} and None not in {r.doc_id for r in rows}
    assert not {2, 3, 4, 7} & {r.doc_id for r in rows}
    inside = [r for r in rows if r.doc_id == 8]
    assert inside and inside[0].kept_chars == 128  # one chunk over and over


def test_every_repeated_chunk_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {(r.doc_id, r.start, r.end) for r in D.repeated_passages(docs).collect()}
    seen, runs = {}, set()
    pieces = {}
    for r in docs.select("doc_id", "text").collect():
        body = r.text.encode()
        ends = D.boundaries(body, D.Chunking())
        pieces[r.doc_id] = [(len(body[:a].decode()), len(body[:b].decode()), body[a:b]) for a, b in zip(np.append(0, ends[:-1]), ends, strict=True)]
        for _, _, c in pieces[r.doc_id]:
            seen[c] = seen.get(c, 0) + 1
    for i, parts in pieces.items():
        run = None
        for a, b, c in [*parts, (10**9, 10**9, b"")]:
            if seen.get(c, 0) > 1 and run and run[1] == a:
                run = (run[0], b)
            else:
                if run and run[1] - run[0] >= 128:
                    runs.add((i, *run))
                run = (a, b) if seen.get(c, 0) > 1 else None
    assert got == runs


def exact(texts, least=51):
    """For each text the runs of words in windows that occur twice or more, by all windows, and the characters in ones that occur before."""
    places = {}
    spans = {i: [(m.start(), m.end()) for m in re.finditer(r"\S+", t or "")] for i, t in sorted(texts.items())}
    for i, w in spans.items():
        for k in range(len(w) - least + 1):
            places.setdefault(texts[i][w[k][0] : w[k + least - 1][1]], []).append((i, k))
    want = {}
    for own in places.values():
        for n, (i, k) in enumerate(own if len(own) > 1 else []):
            again, dropped = want.setdefault(i, (set(), set()))
            span = range(spans[i][k][0], spans[i][k + least - 1][1])
            again.update(span)
            if n:
                dropped.update(span)
    out = set()
    for i, (again, dropped) in want.items():
        for a in sorted(x for x in again if x - 1 not in again):
            b = next(x for x in range(a, len(texts[i]) + 1) if x not in again)
            out.add((i, a, b, len(dropped & set(range(a, b)))))
    return out


def exact_got(df, how=D.Exact()):
    rows = df.collect()
    assert all(r.kept_chars + r.dropped_chars == r.end - r.start and r.n_words >= how.least for r in rows)
    got = {(r.doc_id, r.start, r.end, r.dropped_chars) for r in rows}
    assert len(got) == len(rows)
    return got


def test_short_passages_are_all_found_to_their_ends(spark):
    passages = [rng_prose(100 + i, 51) if i % 2 else " ".join("abcdefghijk"[random.Random(i * 60 + j).randrange(11)] for j in range(51)) for i in range(30)]
    docs = [(2 * i + k, f"{rng_prose(1000 + 2 * i + k, 40 + 20 * k)} {p} {rng_prose(5000 + 2 * i + k, 30)}") for i, p in enumerate(passages) for k in (0, 1)]
    docs += [(1000 + i, f"{rng_prose(9000 + i, 60)} {rng_prose(7000 + i // 2, 50)} {rng_prose(8000 + i, 60)}") for i in range(30)]  # a word too few
    rows = D.exact_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    texts = dict(docs)
    assert sorted(r.doc_id for r in rows) == list(range(60))
    for r in rows:
        assert texts[r.doc_id][r.start : r.end] == passages[r.doc_id // 2] and r.n_words == 51
        assert (r.dropped_chars == 0) == (r.doc_id % 2 == 0) and (r.kept_chars == 0) == (r.doc_id % 2 == 1)


def test_exact_passages_by_all_windows(spark):
    rng = random.Random(4)
    parts = [rng_prose(300 + i, rng.randint(20, 140)) for i in range(12)] + ["\u00e9t\u00e9\u00a0\u00fc\u3000" * 30, "a " * 80, "one two three " * 30]
    docs = {i: rng.choice((" ", "\n", "\t ")).join([rng.choice(parts) if rng.random() < 0.6 else rng_prose(400 + 9 * i + j, rng.randint(1, 40)) for j in range(rng.randint(0, 7))]) for i in range(80)}
    for i in range(80, 90):
        docs[i] = docs[i - 40]
    want = exact(docs)
    assert exact_got(D.exact_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))) == want and len(want) > 60


def test_exact_passages_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert exact_got(D.exact_passages(docs)) == exact({r.doc_id: r.text for r in docs.collect()})


def test_odd_rows_of_exact_passages(spark, odd, none):
    assert D.exact_passages(none).count() == 0
    assert D.exact_passages(odd).filter("doc_id is null or doc_id <> 5").count() == 0
    how = D.Exact(least=3, seed=2)
    got = {(r.doc_id, r.start, r.end) for r in D.exact_passages(odd.filter("doc_id <> 5"), how).collect()}
    assert got == {(1, 0, 16), (6, 0, 16)}
