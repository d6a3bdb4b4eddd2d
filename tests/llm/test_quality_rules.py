import random
import re

from tidemark.llm import quality_rules as R

from .conftest import prose


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    three = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, t in enumerate(three) if three.count(t) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_base_by_brute_force(spark):
    rng = random.Random(8)
    texts = ["", None, "a a a a", "é\x85ü\xa0x\x1cy", "one\n one\none\n\n \none", "\x0b\x0c", "#$ % <<>>"]
    for _ in range(60):
        few = [rng.choice(("a", "b%", "ça", "d|")) for _ in range(4)]
        texts.append("".join(rng.choice([*few, " ", " ", "\n", "\t", "  "]) for _ in range(rng.randint(0, 150))))
    texts += [prose(rng, 60), prose(rng, 49)]
    got = R.compression_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in got.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_bands(spark):
    rng = random.Random(9)
    clean = prose(rng, 300, ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(2000)])
    noise = " ".join("".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(5)) for _ in range(100))
    again = " ".join(f"{w}{i}" for i in range(10) for w in ["spam" * 10] * 8)
    mixed = clean + "\n" + "ab " * 20_000
    got = {r.doc_id: r for r in R.compression_rules(spark.createDataFrame([(1, clean), (2, noise), (3, again), (4, mixed)], "doc_id long, text string")).collect()}
    assert got[1].kept and not got[2].kept and not got[3].kept and not got[4].kept
    assert got[3].ratio < 0.2 and got[4].bad_chunks > 0.5 and got[2].ratio > got[1].ratio


def test_odd_rows(odd, none):
    assert R.compression_rules(none).count() == 0
    rows = R.compression_rules(odd).collect()
    assert len(rows) == odd.count() and [r.ratio for r in rows if r.doc_id in (2, 3)] == [None, None]
    assert next(r for r in rows if r.doc_id == 5).n_words == 120_000


def test_names_with_dots(spark):
    docs = spark.createDataFrame([(1, "a b")], "`doc.id` long, `te.xt` string")
    row = R.compression_rules(docs, doc_id="doc.id", text="te.xt").first()
    assert (row["doc_id"], row["n_words"]) == (1, 2)
