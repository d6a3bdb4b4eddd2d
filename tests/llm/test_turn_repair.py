import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import turn_repair as T

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """The least (cost, audit) over all ways to keep, rerole, delete and insert (two inserts before each row and at the end)."""
    seen, kinds = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\r\x0b\x0c")
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    options = []
    for (role, _), kind in zip(rows, kinds):
        mine = [(2, "D", "")]
        if kind not in ("blank", "duplicate"):
            more = 5 if kind == "truncated" else 0
            mine += [(more, "K", role[:1] or "-"), (1 + more, "R", "u"), (1 + more, "R", "a")]
        options.append(mine)
    inserts = [(5 * n, "I" * n, "".join(x)) for n in range(3) for x in itertools.product("ua", repeat=n)]
    steps = [inserts]
    for mine in options:
        steps += [mine, inserts]
    ways = {"": (0, "")}  # by the roles so far; prefixes that can't become the form go
    for step in steps:
        new = {}
        for roles, (cost, audit) in ways.items():
            for c, edit, out in step:
                r = roles + out
                if not re.fullmatch(r"s?(ua)*u?", r):
                    continue
                # audits of one set of roles and equal cost differ in length only if inserts differ; those are never cheapest
                if r not in new or (cost + c, audit + edit) < new[r]:
                    new[r] = (cost + c, audit + edit)
        ways = new
    best = min(v for r, v in ways.items() if FORM.fullmatch(r))
    return best, kinds


def repaired(rows, audit):
    out, turn = [], "user"
    for (role, text), e in zip(rows, audit, strict=True):
        if e == "D":
            continue
        role = role if e == "K" else turn
        turn = "assistant" if role[:1] == "u" else "user"
        out.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(conv_id, rows):
    """rows (turn, role, text) as they are after nulls have become spaces."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    said = [(r, t) for _, r, t in rows]
    (cost, audit), kinds = brute(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for r, _ in said]
    broken = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (conv_id, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), broken, cost, audit, repaired(said, audit))


def random_rows(rng, n):
    texts = ["Yes.", "No!", "cut", "", " \n", "Why?", "Fine. ", "é."] + [f"t{i}." for i in range(30)]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", " ", "", "usher"]
    return [(rng.choice([None, i, i, i, i + 3]), rng.choice(roles), rng.choice(texts)) for i in range(n)]


@pytest.fixture(scope="module")
def many():
    rng = random.Random(12)
    return {c: random_rows(rng, rng.choice([1, 1, 2, 3, 4, 5, 7, 12])) for c in range(150)} | {-5: random_rows(rng, 150), None: random_rows(rng, 9)}


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, many):
    return spark.createDataFrame([(c, t, r, x) for c, rows in many.items() for t, r, x in rows], SCHEMA)


@pytest.mark.parametrize("batch", [10_000, 7, 1])
def test_repair_is_the_cheapest(spark, many, batch):
    """Whatever the slices: whole conversations, and pieces down to a row."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(batch))
    try:
        got = as_rows(T.repair(frame(spark, many)))
    finally:
        spark.conf.set(key, before)
    assert got == sorted((expected(c, rows) for c, rows in many.items()), key=repr)


def test_hot_conversation_over_partitions(spark):
    """A conversation of all rows lies in several partitions, equal rows among them."""
    rows = [(1, None, "user", "same.")] * 400 + [(1, i, ("user", "assistant")[i % 2], f"text {i % 50}.") for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    parts = T.sliced(T.ordered(df.select("*"), F.lit(True))).select("part").distinct().count()
    got = T.repair(df).first()
    assert parts > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    assert got["duplicate"] == 399 + 350 and len(got["audit"]) == 800 and got["blank"] == 0 and got["gaps"] == 0


def test_damage(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"one. two! {c}?") for c in range(40) for t in range(8)] + [(None, None, None, None), (7, None, "user", None)]
    got = {}
    for r in T.damage(spark.createDataFrame(rows, SCHEMA)).filter("there").collect():
        got.setdefault((r[0], r[1]), []).append((r[2], r[3]))
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        want = [] if k == 0 else [("user" if k == 4 else role, text)] * (2 if k == 3 else 1)
        assert got.get((c, t), []) == want


def test_survivors_forget_what_is_settled():
    """Of ten thousand turns in order only a few are held at a time."""
    out, most = [], 0
    search = T.Survivors(T.NOTHING, lambda e, i: out.append((e, i)), T.Costs().gaps())
    for i in range(10_000):
        search.step(T.Costs().moves("ua"[i % 2], None), i)
        most = max(most, i + 1 - len(out))
    assert search.end() == 0 and out == [("K", i) for i in range(10_000)] and most < 10


def test_costs_that_would_need_inserts_are_refused():
    with pytest.raises(ValueError):
        T.Costs(insert=4)
    with pytest.raises(ValueError):
        T.Costs(keep=-1)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair(empty).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "x."), (None, None, None, None)], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert as_rows(T.repair(gone, F.lit(False))) == sorted([(1, 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)], key=repr)
    long = "x" * 2_000_000 + "."
    more = spark.createDataFrame([(1, 0, "user", long, [1], {"a": 1}, "p"), (1, 1, "assistant", "\t" * 1_000_000, None, None, None)], SCHEMA + ", there array<int>, at map<string,int>, part string")
    r = T.repair(more).first()
    assert (r["audit"], r["blank"], r["cost"]) == ("DD", 1, 4)
    assert len(T.repair(more).columns) == 9


def test_query_equals_plain_code(spark, sf):
    got = as_rows(T.op12_survivor_coalescence(spark, sf))
    convs = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        rows = convs.setdefault(r["conv_id"], [])
        k = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", r["text"]) if k == 2 else r["text"]
        rows += [] if k == 0 else [(r["turn"], "user" if k == 4 else r["role"], text)] * (2 if k == 3 else 1)
    assert got == sorted((expected(c, rows) for c, rows in convs.items()), key=repr)
