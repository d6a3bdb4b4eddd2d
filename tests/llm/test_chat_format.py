import hashlib

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import chat_format as C

ROWS = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumn("parts", C.text_parts(F.col("text")))
    return C.read_back(C.format_chat(df))


nasty = st.lists(st.sampled_from(["</s>", "<s>[ROLE]", "[TEXT]", "\\", "\\l", "\\e", "<", "[", "<image>", "a", "é", "\n", "", "\x00"]), max_size=6).map("".join)


@settings(max_examples=12, deadline=None)
@given(texts=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "[TEXT]", "</s>"]), nasty), min_size=1, max_size=8))
def test_round_trip(spark, texts):
    got = formatted(spark, [(1, i, r, t) for i, (r, t) in enumerate(texts)]).first()
    assert [(x.role, x.text, x.media) for x in got.turns] == [(r, t, []) for r, t in texts]
    assert got.loss_text == "".join(t for r, t in texts if r == "assistant")


def test_query_against_sql(spark, sf):
    got = sorted(map(tuple, C.op7_typed_parts(spark, sf).collect()))
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    assert got == sorted(db.execute(C.OP7_SQL).fetchall())
    assert {x for r in got for x in r[7].split(",")} == {"", *C.PLACEHOLDERS} and sum(r[8] for r in got) > 0
    said = f"user\n{C.PLANTED}\nassistant\n{C.PLANTED}\n"
    planted = next(r for r in got if r[0] == -1)
    assert planted[1:5] == (2, hashlib.sha256(said.encode()).hexdigest(), len(C.PLANTED), hashlib.sha256(C.PLANTED.encode()).hexdigest())


def test_typed_parts(spark):
    parts = [("text", "see <image> ", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None), ("audio", None, "b.wav", None, None, 2.0, None)]
    rows = [(1, 0, "user", parts), (1, 1, "assistant", [("text", "fine", *[None] * 5), ("image", None, "e.png", *[None] * 4), ("text", "too", *[None] * 5)]), (1, 2, "user", [("document", None, "c.pdf", None, None, None, 2), ("image", None, "d.png", *[None] * 4), ("other", "x", *[None] * 5)]), (1, 3, "user", None)]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {C.PART}")
    r = C.read_back(C.format_chat(df)).first()
    assert [(t.text, t.media) for t in r.turns] == [("see <image> ", ["image", "audio"]), ("finetoo", ["image"]), ("x", ["document", "image"]), ("", [])]
    assert [tuple(a) for a in r.attachments] == [(0, "image", "a.png", 3), (0, "audio", "b.wav", 25), (1, "image", "e.png", 1), (2, "document", "c.pdf", 1536), (2, "image", "d.png", 1)]
    assert r.media_tokens == 3 + 25 + 1 + 1536 + 1
    assert r.formatted.count("<image>") == 3 and "\\limage>" in r.formatted
    assert [r.formatted[s.start : s.end] for s in r.loss_spans] == ["fine", "too"] and r.loss_text == "finetoo"


def test_nulls_ties_and_no_rows(spark):
    rows = [(1, 1, "user", "b"), (1, 1, "user", "b"), (1, None, None, None), (None, 0, "assistant", ""), (None, 0, "assistant", ""), (2, 0, "user", "x" * 500_000)]
    assert sum(r.conv_id is None and len(r.turns) == 1 for r in formatted(spark, rows).collect()) == 2
    got = {r.conv_id: r for r in formatted(spark, rows).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [("", ""), ("user", "b"), ("user", "b")]
    assert [(t.role, t.text) for t in got[None].turns] == [("assistant", "")] and got[None].loss_text == ""
    assert len(got[2].turns[0].text) == 500_000
    assert formatted(spark, []).count() == 0
