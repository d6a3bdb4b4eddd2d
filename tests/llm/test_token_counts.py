import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import token_counts as T

from .conftest import prose


def plain(body: str, spans, rule):
    """Token by token with another library's offsets."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    ids = t.encode(body, add_special_tokens=False)
    count = [0.0] * (len(spans) + 1)
    for s, e in ids.offsets:
        parts = [max(0, min(e, b) - max(s, a)) for a, b in spans]
        parts.append((e - s) - sum(parts))
        if rule == "share":
            for i, p in enumerate(parts):
                count[i] += p / (e - s)
        elif rule == "most":
            count[parts.index(max(parts))] += 1
        else:
            count[next((i for i, (a, b) in enumerate(spans) if a <= s < b), len(spans))] += 1
    return count, len(ids.ids)


@pytest.mark.parametrize("rule", T.RULES)
def test_against_offsets_of_another_library(rule):
    rng = random.Random(1)
    for text in (prose(rng, 50), "One. Two!  Three\n\nfour five's 123 <|endoftext|>", "naïve café — über. Ça va? Ñandú"):
        spans = []
        at = 0
        while at < len(text):  # touching and apart, cutting words
            end = min(len(text), at + rng.randint(1, 9))
            spans.append((at, end))
            at = end + rng.choice((0, 0, 2))
        s, e = T.token_spans(text.encode(), T.VOCABULARY)
        lo, hi = (np.array(x) for x in zip(*spans, strict=True))
        tokens, crossing = T.attribute(s, e, lo, hi, rule)
        want, n = plain(text, spans, rule)
        assert len(s) == n and tokens.sum() == pytest.approx(n)
        assert tokens == pytest.approx(want)
        assert crossing[:-1].tolist() == [sum(x < b and y > a and not (a <= x and y <= b) for x, y in zip(s, e, strict=True)) for a, b in spans]


def test_sections():
    lo, hi = T.section_spans("é. Ab!\ncd".encode(), "sentences")
    assert list(zip(lo, hi, strict=True)) == [(0, 3), (3, 7), (7, 9)]
    lo, hi = T.section_spans("é. Ab!\ncd\n".encode(), "lines")
    assert list(zip(lo, hi, strict=True)) == [(0, 7), (7, 10)]


def test_odd_rows(spark, odd, none):
    got = T.token_counts(odd, sections="sentences")
    rows = got.collect()
    assert T.token_counts(none).count() == 0
    assert sorted(r.doc_id is None for r in rows).count(True) == 2
    empty = [(r.section, r.start, r.end, r.n_tokens) for r in rows if r.doc_id in (2, 3)]
    assert empty == [(0, 0, 0, 0.0)] * 2
    assert len([r for r in rows if r.doc_id == 6]) == 2
    sums = got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.max("doc_tokens").alias("t"), F.count("*").alias("c")).filter("doc_id not in (6)").collect()
    assert all(r.n == r.t for r in sums)


def test_bytes_that_are_no_text(spark):
    bad = b"one \xff\xfe two\n\xc3\n\xed\xa0\x80 three \xc3\xa9"
    df = spark.createDataFrame([(1, bytearray(bad))], "doc_id long, text binary")
    got = sorted(T.token_counts(df).collect(), key=lambda r: r.section)
    want = spark.createDataFrame([(1, bad.decode("utf-8", "replace"))], "doc_id long, text string")
    assert got == sorted(T.token_counts(want).collect(), key=lambda r: r.section) and len(got) == 3
    assert got[-1].end == len(bad.decode("utf-8", "replace"))


def test_fields(spark):
    df = spark.createDataFrame([(1, "Title words", None, "Body. More"), (2, None, None, None)], "doc_id long, title string, note string, main string")
    text, spans = T.joined_fields({c: F.col(c) for c in ("title", "note", "main")}, " ")
    got = T.token_counts(df.select("doc_id", text.alias("text"), spans.alias("spans")), rule="share", spans="spans").collect()
    first = {r.section: r.n_tokens for r in got if r.doc_id == 1}
    assert first[0] > 0 and first[1] == 0 and first[2] > 0 and sum(first.values()) == pytest.approx(next(r.doc_tokens for r in got if r.doc_id == 1))
    with pytest.raises(ValueError):
        T.token_counts(df, rule="other")


def test_long_runs_of_white_space(spark):
    """Cut out before they reach the pattern, with the tokens that the pattern gives them."""
    encoding, _ = T.encoder(T.VOCABULARY)
    for before in ("x", "x.", ""):
        for run in (" " * 2000, "\n" * 2500, " \n" * 2000, "　" * 2100, " " * 1999):
            for after in ("y", "", "1", "!\n", "\x1cz"):
                body = before + run + after + run + after
                assert np.array_equal(T.token_ids(body, T.VOCABULARY), encoding.encode_to_numpy(body))
    row = T.token_counts(spark.createDataFrame([(1, "a" + " " * 1_000_000 + "b")], "doc_id long, text string")).first()
    assert row["doc_tokens"] == row["n_tokens"] > 2
