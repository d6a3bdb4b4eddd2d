import corpus_pipeline as C
from tidemark.llm import near_dups as N
from tidemark.llm import queries
from tidemark.llm.common import materialise

from tidemark.llm.pipeline import TARGETS

from .test_decontaminate import plain as overlap
from .test_near_dups import plain as groups
from .test_pii import plain as personal


def test_stages_on_a_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in C.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = materialise(stage(spark, docs, sf), name)
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r for r in docs.collect()})
    before, after = kept["quality"]
    low = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 0").collect()}
    assert len(low & set(after)) <= len(low) // 10 and len(after) > 0.8 * len(before)
    before, after = kept["near_dups"]
    assert set(after) == {i for i, (_, c) in groups(before.items()).items() if c == i}
    before, after = kept["benchmark"]
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for i, text in before.items():
        hit = any(s >= 8 and m >= 10 for s, m in (overlap(text, x) for x in items)) if i % 4 == 0 or i not in after else False
        assert (i not in after) == hit
    before, after = kept["personal"]
    assert set(before) == set(after)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and not personal(r.text)
        assert r.text == before[i] or any(c in before[i] for c in "0123456789@")
    last = C.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in last} == set(after) and all(r.rate >= 0 for r in last)


DOCS = "doc_id long, text string, lang string, source string, n_chars int"


def test_odd_rows_in_every_stage(spark, odd_rows, none, sf):
    """Nulls in every column, empty, very long and repeated texts, repeated ids, and columns with the names of results."""
    rows = [(i, t, None, "s", None if t is None else len(t), 0.5, "x") for i, t, *_ in odd_rows]
    docs = spark.createDataFrame(rows, DOCS + ", p_ge_1 double, `kept` string")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        got = out.collect()
        if name in ("benchmark", "personal"):
            assert len(got) == len(rows)
        if name == "near_dups":
            assert sorted(str(r.doc_id) for r in got) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, 9, None, None]))
        if name == "quality":
            assert all(r.p_ge_1 == 0.5 for r in got)
        assert stage(spark, docs.limit(0), sf).count() == 0
    last = C.STAGES[-1][1](spark, docs, sf)
    assert last.count() == len(rows) and "reached_good" in last.columns
    assert C.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_rows_that_repeat_go_once(spark, sf):
    docs = spark.createDataFrame([(1, "some words", "en", "s", 10), (1, "some words", "en", "s", 10), (2, "other things", "en", "s", 12), (2, "more of them", "en", "s", 12)], DOCS)
    got = [r.doc_id for r in dict(C.STAGES)["near_dups"](spark, docs, sf).collect()]
    assert sorted(got) == [1, 2] and sum(TARGETS.values()) == 1


def test_run_and_registration(spark, sf):
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert C.run(spark, sf).count() > 0 and len(C.STAGES) == 5 and C.ORACLE_SQL is None
    assert N.WORDS == 5 and N.PERCENT == 75
