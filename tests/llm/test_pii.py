import hashlib
import random
import re

import numpy as np

from tidemark.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def strings():
    rng = random.Random(6)
    fixed = ["a@b.c@d.e", "x@a.b_c@d.e f@g", "@@a.b", "1.2.3.45.6.7.8", "1.2.3.4.5.6.7.8", "0001.2.3.4 256.1.1.1", "4111 1111-1111 1111", "4111111111111112", "+1 (988) 555-2485.", "+12", "++123456789-", "é +44 20 7946 0958é"]
    return fixed + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for alphabet in ("ab@.-_1", "019.", "0145 -", "+1 ().-2", "a@.1 -+(é") for _ in range(400)]


def test_base_by_brute_force():
    for s in strings():
        assert P.base_spans(s) == plain(s), s


def test_long_runs_are_fast():
    for s in ("a" * 500_000 + "@", "1" * 500_000, "1." * 200_000, "+1" * 100_000, "@" * 300_000, "1 " * 200_000):
        P.base_spans(s)


def test_query_columns(spark):
    texts = strings()[:200]
    got = P.find_personal(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in got:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in P.KINDS]
        assert r.spans.startswith(",".join(f"{k}:{a}:{b}" for k, a, b in want))


def secrets(spark):
    rng = random.Random(3)
    h = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    k = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    rows = []
    for i in range(60):
        rows += [(f"words password=a1{h(16)} more", "secret"), (f'words token = "b2{h(38)}" more', "secret"), (f"words AKIA2{k(15)} more", "secret")]
        rows += [(f"version_2_of_{i}_document", ""), (f"1111111111111{i % 10}{i}", ""), (f"chapter-{i}-and-more-words-in-it", "")]
    return [(i, *r) for i, r in enumerate(rows)]


def test_secrets_are_added(spark):
    rows = secrets(spark)
    got = {r.doc_id: r for r in P.find_personal(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for i, text, kind in rows:
        assert [s.kind for s in got[i].added] == ([kind] if kind else []), text
    r = got[0].added[0]
    assert rows[0][1][r.start : r.end].startswith("password=")


def test_names_addresses_and_ids_are_added(spark):
    rows = []
    for i in range(30):
        rows += [(f"my name is Maria Lopez and {i}", ["name"]), (f"wrote Mr. John Smith {i} times", ["name"]), (f"lives at {i + 1} Baker Street now", ["address"])]
        rows += [(f"SSN 1{i:02d}-45-6789 given", ["id"]), ("IBAN DE89370400440532013000 given", ["id"]), (f"plain Words Here And {i} more", [])]
        rows += [(f"order DE8937040044053201{i:04d} placed", [])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: [s.kind for s in r.added] for r in P.find_personal(df).collect()}
    found = [got[i] == want for i, (_, want) in enumerate(rows)]
    assert sum(found) / len(found) > 0.9
    text = P.redacted(df).filter("doc_id = 2").first().text
    assert text == "lives at [ADDRESS] now"


def test_recall_on_the_planted_secrets(spark):
    """Secrets in the table stand in quotes behind a word; all of them are found, and nothing else is added."""
    planted = re.compile(r'(?i)token = "([0-9a-f]{16,})"')
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: [(s.start, s.end) for s in r.added] for r in P.find_personal(docs).collect()}
    want = {r.doc_id: [m.span(1) for m in planted.finditer(r.text or "")] for r in docs.collect()}
    assert got == want and sum(map(len, want.values())) > 0


def test_the_context_can_say_no():
    assert P.secret_votes("9807915762804490", "nte by the road ")[2] == P.NO and P.secret_votes("a1b2c3d4e5f6a7b8", 'token = "')[2] == P.YES
    assert P.secret_votes("a1b2c3d4e5f6a7b8", "x: ")[2] == P.NONE


def test_reliabilities_are_recovered():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = np.array([0.95, 0.9, 0.8, 0.6])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = 2
    pattern, at, n = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, table = P.reliabilities(pattern, n.astype(float))
    assert np.mean((post[at.ravel()] > 0.5) == truth) > 0.94
    got = table[:, 1, 1] / (table[:, 1, 0] + table[:, 1, 1])
    assert np.abs(got - right).max() < 0.05


def test_patterns_are_bounded():
    for code in (0, 1, P.PATTERNS - 1):
        votes, features = P.unpack(code)
        assert len(votes) == P.LABELERS and all(x < n for x, n in zip(features, P.FEATURES, strict=True))
    assert all(0 <= P.pattern_of(s, "token = ") < P.PATTERNS and P.kind_of(P.pattern_of(s, "")) == "secret" for s in strings() if s)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd, +1 (988) 555-2485 end", "x", 0), (2, None, None, None), (3, "", "y", 1), (4, "é", "z", 9)], "doc_id long, text string, body string, n_chars long")
    got = {r.doc_id: r for r in P.redacted(df, "n_chars").collect()}
    assert P.redacted(df).columns == df.columns
    assert got[1].text == "mail [EMAIL], [PHONE] end" and got[1].n_chars == len(got[1].text) and got[1].body == "x"
    assert (got[2].text, got[2].n_chars, got[3].text, got[4].n_chars) == (None, None, "", 1)


def test_odd_rows(odd, none):
    got = P.find_personal(odd)
    assert got.count() == odd.count() and P.find_personal(none).count() == 0
    assert {r.spans for r in got.filter("doc_id is null or doc_id < 5").collect()} == {""}
    assert P.redacted(odd).columns == odd.columns and P.redacted(none).count() == 0
