import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import slices as L
from tidemark.operators import windows as W

T0 = datetime(2024, 1, 1)


def series(spark, seed=1, n=700):
    """Two areas with gaps of all lengths, and one of few rows."""
    rng = random.Random(seed)
    rows, at = [], {"a": 0, "b": 5000, None: 3}
    for _ in range(n):
        area = rng.choice(["a", "a", "a", "b", None] if rng.random() < 0.9 else ["b"])
        at[area] += rng.choice([1, 1, 1, 1, 2, 30, 200])
        rows.append((area, T0 + timedelta(hours=at[area]), rng.choice([None, float(rng.randrange(100))])))
    return spark.createDataFrame(rows, "dk_area string, ts timestamp, v double")


def same(a, b):
    key = lambda r: repr([None if x is None else round(x, 9) if isinstance(x, float) else x for x in r])
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


@pytest.mark.parametrize("rows", [1, 7, 100])
@pytest.mark.parametrize("cell", ["1 hour", "10 days"])
def test_windows_of_rows_equal_whole_series(spark, rows, cell):
    df = series(spark)
    whole = Window.partitionBy("dk_area").orderBy("ts")

    def compute(d, w):
        return d.withColumns({"l": F.lag("v", 40).over(w), "l1": F.lag("v", 1).over(w), "m": F.avg("v").over(w.rowsBetween(-40, -1)), "n": F.count("*").over(w.rowsBetween(-17, -1))})

    same(L.over_rows(df, "dk_area", "ts", 40, compute, rows, cell), compute(df, whole))


def test_windows_of_time_equal_whole_series(spark):
    df = series(spark, 2)
    for span in ("30 days", "50 hours", "1 hour"):
        same(W.time_trailing_mean(df, "v", 72, "m", span=span), W.time_trailing_mean(df, "v", 72, "m", span=None))


def test_no_slice_holds_a_series(spark):
    df = spark.range(3000).select(F.lit("a").alias("dk_area"), (F.lit(T0) + F.make_interval(hours=F.col("id").cast("int"))).alias("ts"), F.col("id").cast("double").alias("v"))
    seen = []

    def compute(d, w):
        seen.append(d.groupBy("dk_area", "_slice").count().agg(F.max("count"), F.count("*"), F.sum("count")).first())
        return d

    assert L.over_rows(df, "dk_area", "ts", 168, compute, 300).count() == 3000
    largest, slices, rows = seen[0]
    assert largest <= 300 + 24 + 168 and slices >= 9 and rows <= 3000 + 168 * slices


def test_named_features(spark):
    df = series(spark, 3, 300)
    for f in (lambda n: W.row_lags(df, "v", [2, 9], slice_rows=n), lambda n: W.trailing_mean(df, "v", 9, "m", slice_rows=n), lambda n: W.row_features(df, "v", slice_rows=n)):
        same(f(20), f(None))
    both = W.rolling_stats(W.lag_features(df, "v", slice_rows=50), "v", slice_rows=50)
    same(both.select(sorted(both.columns)), (lambda d: d.select(sorted(d.columns)))(W.row_features(df, "v", slice_rows=None)))
    empty = df.limit(0)
    assert W.row_lags(empty, "v", [2]).count() == 0
