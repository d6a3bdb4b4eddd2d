import math
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import rollups as R
from tidemark.operators import series as S
from tidemark.operators import sinks

SCHEMA = "time timestamp, value double, type string"
T0 = datetime(2024, 1, 1)


def rows(n, seed=1, days=4):
    rng = random.Random(seed)
    return [(T0 + timedelta(seconds=rng.randrange(days * 86400)), rng.choice([None, 1e6 + rng.random(), 1e6 + rng.random()]), rng.choice(["a", "b", None])) for _ in range(n)]


def stored(df, path):
    df.withColumn("day", F.to_date("bucket")).write.partitionBy("day").parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("rolled"))
    df = spark.createDataFrame(rows(3000), SCHEMA)
    df.withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(base + "/raw")
    raw = spark.read.parquet(base + "/raw")
    fine = stored(R.moments(raw, "5 minutes"), base + "/five")
    hours = stored(R.coarser_moments(fine, "1 hour"), base + "/hours")
    days = stored(R.coarser_moments(hours, "1 day"), base + "/days")
    return raw, {"5 minutes": fine, "1 hour": hours, "1 day": days}


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(sorted(a, key=repr), sorted(b, key=repr)):
        for u, v in zip(x, y):
            assert u == v or math.isclose(u, v, rel_tol=1e-9), (x, y)


EDGES = [(T0, T0 + timedelta(days=3)), (T0 + timedelta(minutes=7, seconds=3), T0 + timedelta(days=2, hours=5, seconds=1)), (T0 + timedelta(hours=5, minutes=1), T0 + timedelta(hours=5, minutes=4)), (T0 - timedelta(days=3), T0 + timedelta(days=9, seconds=1))]


@pytest.mark.parametrize("span", EDGES)
@pytest.mark.parametrize("width", ["5 minutes", "7 minutes", "1 hour", "1 day", "1 month", None])
def test_any_range_equals_raw_history(store, span, width):
    raw, rolled = store
    for series in (None, "a"):
        close([tuple(r) for r in R.from_rollups(rolled, raw, *span, series, width).collect()], [tuple(r) for r in S.historical(raw, *span, series, width).collect()])


@pytest.mark.parametrize("span", EDGES)
def test_stats_with_deviations(store, span):
    """Values of a million with deviations under one: nothing is lost to the means."""
    raw, rolled = store
    got, want = ({r["type"]: r for r in f(*span).collect()} for f in (lambda *s: R.stats_from_rollups(rolled, raw, *s), lambda *s: S.stats(raw, *s)))
    assert set(got) == set(want)
    for k, r in want.items():
        assert got[k]["count"] == r["count"] and got[k]["min"] == r["min"] and got[k]["max"] == r["max"]
        for c in ("avg", "stddev"):
            assert (got[k][c] is None) == (r[c] is None) and (r[c] is None or math.isclose(got[k][c], r[c], rel_tol=1e-7)), (k, c)


def test_cover():
    widths = ["1 day", "1 hour", "5 minutes"]
    lo, hi = T0 + timedelta(hours=22, minutes=58, seconds=30), T0 + timedelta(days=3, minutes=5, seconds=1)
    legs = R.cover(lo, hi, widths)
    assert legs[0][1] == lo and legs[-1][2] == hi and all(a[2] == b[1] for a, b in zip(legs, legs[1:]))
    assert [x[0] for x in legs] == ["raw", "1 hour", "1 day", "5 minutes", "raw"]
    assert sum((b - a for s, a, b in legs if s == "raw"), timedelta()) < timedelta(minutes=10)
    assert R.cover(T0, T0, widths) == [] and R.cover(lo, hi, []) == [("raw", lo, hi)]
    assert R.usable("2 hours", ("5 minutes", "1 hour", "1 day")) == ["1 hour", "5 minutes"] and R.usable("7 minutes", ("5 minutes",)) == []


def scans(df):
    """Partition filters of each scan in the plan."""
    return [x.split("]")[0] for x in df._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1:]]


def test_raw_rows_are_read_at_the_edges_only(store):
    raw, rolled = store
    df = R.from_rollups(rolled, raw, *EDGES[1], None, "1 day")
    df.collect()
    files = lambda d: {os.path.basename(os.path.dirname(f)) for f in d.inputFiles()}
    legs = [(lo, hi) for s, lo, hi in R.cover(*EDGES[1], ["1 day", "1 hour", "5 minutes"]) if s == "raw"]
    assert legs == [(EDGES[1][0], T0 + timedelta(minutes=10)), (T0 + timedelta(days=2, hours=5), EDGES[1][1])]
    assert files(R.within(raw, "time", legs)) >= {"day=2024-01-01", "day=2024-01-03"}
    read = R.within(raw, "time", legs).select("day").distinct().collect()
    assert {str(r[0]) for r in read} <= {"2024-01-01", "2024-01-03"}
    assert len(scans(df)) in (4, 8) and all("day" in f for f in scans(df))  # four sources, in the first plan and the last


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_refresh_makes_dirty_buckets_only(spark, folder):
    """Late and repeated rows in batches: what is stored equals a rebuild, and other days keep their files."""
    store, data = R.RollupStore(spark, folder + "/rolled"), rows(800, 5)
    far = T0 + timedelta(days=30)
    late = [r for r in data if r[0].day == 2][:40]
    first = [r for r in data if r not in late]
    for batch in (first, first[:100]):  # some come twice
        store.note(spark.createDataFrame(batch, SCHEMA))
    spark.createDataFrame(first, SCHEMA).withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(folder + "/raw")
    assert store.refresh(spark.read.parquet(folder + "/raw"), far)["1 day"] > 0
    before = files(folder + "/rolled")
    spark.createDataFrame(late, SCHEMA).withColumn("day", F.to_date("time")).write.mode("append").partitionBy("day").parquet(folder + "/raw")
    store.note(spark.createDataFrame(late, SCHEMA))
    raw = spark.read.parquet(folder + "/raw")
    done = store.refresh(raw, far)
    assert done["5 minutes"] <= 40 and 0 < done["1 day"] <= 3
    kept = {f for f in before if "dirty" not in os.path.relpath(f, folder) and "day=2024-01-02" not in f}
    assert kept and kept <= files(folder + "/rolled")
    for width, df in store.rollups().items():
        close([tuple(r) for r in df.drop("day").collect()], [tuple(r) for r in R.moments(raw, width).collect()])
    assert set(store.refresh(raw, far).values()) == {0}
    assert not [x for x in os.listdir(folder + "/rolled") if ".new-" in x or ".old-" in x]


def test_open_buckets_wait(spark, folder):
    store = R.RollupStore(spark, folder)
    raw = spark.createDataFrame([(T0, 1.0, "a"), (T0 + timedelta(minutes=7), 2.0, "a")], SCHEMA)
    store.note(raw)
    assert store.refresh(raw, T0 + timedelta(minutes=9)) == {"5 minutes": 0, "1 hour": 0, "1 day": 0}
    assert store.refresh(raw, T0 + timedelta(minutes=10)) == {"5 minutes": 1, "1 hour": 0, "1 day": 0}
    assert store.refresh(raw, T0 + timedelta(hours=2)) == {"5 minutes": 1, "1 hour": 1, "1 day": 0}
    assert store.refresh(raw, T0 + timedelta(days=2)) == {"5 minutes": 0, "1 hour": 0, "1 day": 1}
    assert [(r["rows"], r["sum"]) for r in store.read("1 day").collect()] == [(2, 3.0)]


def test_buckets_without_rows_go(spark, folder):
    store = R.RollupStore(spark, folder)
    raw = spark.createDataFrame([(T0, 1.0, "a"), (T0 + timedelta(days=1), 2.0, "a")], SCHEMA)
    store.note(raw)
    store.refresh(raw, T0 + timedelta(days=9))
    store.note(raw.limit(1))
    store.refresh(raw.filter(F.col("time") > F.lit(T0)), T0 + timedelta(days=9))
    assert [r["sum"] for r in store.read("1 hour").collect()] == [2.0]


def test_widths_must_nest(spark, folder):
    with pytest.raises(ValueError):
        R.RollupStore(spark, folder, ("7 minutes", "1 hour"))
    with pytest.raises(ValueError):
        S.refresh_rollup(None, None, T0 + timedelta(minutes=1), T0 + timedelta(hours=1), "5 minutes")


def test_bitmaps(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, rng.randrange(200_000)]), rng.choice("xy"), T0 + timedelta(minutes=rng.randrange(3000))) for _ in range(4000)]
    obs = spark.createDataFrame(data, "s long, area string, ts timestamp")
    bits = R.source_bits(obs, "s", ["area"], "1 hour")
    lo, hi = T0 + timedelta(hours=5), T0 + timedelta(hours=30)
    for got, keep in ((R.distinct_sources(bits, ["area"], lo, hi), lambda t: lo <= t < hi), (R.distinct_sources(R.coarser_bits(bits, ["area"], "1 day"), ["area"]), lambda t: True)):
        want = {a: len({s for s, x, t in data if x == a and s is not None and keep(t)}) for a in "xy"}
        assert {r["area"]: r["n_sources"] for r in got.collect()} == want


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_a_small_row_that_comes_again_is_no_loss(spark, folder):
    """rollups_refreshed against its SQL: two rows of a second, the smaller one again in the late batch; values that are null; rows after 2024."""
    import duckdb

    from tidemark.plans.registry import ORACLES, QUERIES

    at = lambda days, s=0: T0 + timedelta(days=days, seconds=s)
    data = [(1, at(3, 5), 40.0), (50, at(3, 5), 20.0), (100, at(3, 9), 70.0), (101, at(3, 9), 60.0), (2, at(4), None), (3, at(800), 30.0), (150, at(9), 10.0)]
    spark.createDataFrame([(i, t, 1, "view", v, None) for i, t, v in data], EVENTS).write.parquet(folder + "/events.parquet")
    got = [tuple(r) for r in QUERIES["rollups_refreshed"](spark, folder).collect()]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = db.execute(ORACLES["rollups_refreshed"]).fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 3 * 4


def test_order_holds_against_what_is_stored(spark, folder):
    """With ordered an old row that comes again changes nothing, a later one wins; without it the batch wins."""
    frame = lambda *rows: spark.createDataFrame(list(rows), "time timestamp, type string, value double, version long")
    for ordered, want in ((True, [("a", 9.0), ("b", 8.0), ("c", 3.0), ("d", 4.0)]), (False, [("a", 1.0), ("b", 8.0), ("c", 3.0), ("d", 4.0)])):
        path = f"{folder}-{ordered}"
        for batch in (frame((T0, "a", 9.0, 2), (T0, "b", 1.0, 1), (T0, "c", 2.0, 1), (T0, "d", 4.0, 1)), frame((T0, "a", 1.0, 1), (T0, "b", 8.0, 2), (T0, "c", 3.0, 1))):
            sinks.upsert_measurements(batch, path, ("version",), ordered=ordered)
        assert sorted((r.type, r.value) for r in spark.read.parquet(path).collect()) == want
