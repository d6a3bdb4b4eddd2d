import pytest

from tidemark import session
from tidemark.llm import common as C


def test_kept_names_give_way():
    assert C.apart(["doc_id", "rate", "Rate_", "n"], ["rate", "n"]) == ["doc_id", "rate__", "Rate_", "n_"]


def test_tables_are_deleted(spark):
    tables = C.Scratch(spark)
    a, b = (tables.keep(spark.range(3), x) for x in "ab")
    tables.drop(keep=("b",))
    assert b.count() == 3
    with pytest.raises(Exception, match="(?i)path|exist"):
        a.count()


def test_one_text_for_each_id(spark):
    rows = [(1, "b"), (1, "a"), (1, None), (2, None), (None, "x")]
    got = lambda r: sorted(map(str, C.one_text(spark.createDataFrame(r, "doc_id long, text string")).collect()))
    assert got(rows) == got(rows[::-1]) and len(got(rows)) == 3


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Spark:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_folder(Spark())
