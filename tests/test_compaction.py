import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import maintenance as X
from tidemark.operators import sinks


def files(path):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def write(df, path, n):
    df.repartition(n).write.mode("append").partitionBy("month").parquet(path)


@pytest.fixture
def mixed(spark, folder):
    """Two partitions with many small files and a large one each; the names of folders are not as Spark would write them."""
    df = spark.range(40_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit("x").alias("month"))
    for month in ("01", "02"):
        part = df.withColumn("month", F.lit(month))
        write(part, folder, 1)
        write(part.limit(8000), folder, 20)
    return folder


def test_small_files_are_joined_by_size(spark, mixed):
    before, rows = files(mixed), spark.read.parquet(mixed).count()
    large = {f for f, n in before.items() if n > 1_000_000}
    target = 200_000
    assert len(large) == 2 and X.compact_small(spark, mixed, target) == len(before) - 2
    after = files(mixed)
    joined = {f: n for f, n in after.items() if f not in large}
    assert large <= set(after) and spark.read.parquet(mixed).count() == rows
    assert 4 <= len(joined) <= 8 and all(n < 1.5 * target for n in joined.values())
    assert {os.path.basename(os.path.dirname(f)) for f in joined} == {"month=01", "month=02"}
    assert not [x for x in os.listdir(mixed) if "compaction" in x]
    assert spark.read.parquet(mixed).distinct().count() == 80_000


@pytest.mark.parametrize("groups", [1, 100])
def test_a_run_that_dies_is_finished(spark, mixed, monkeypatch, groups):
    rows = spark.read.parquet(mixed).count()
    with monkeypatch.context() as m:
        calls = []
        m.setattr(X, "_finish", lambda spark, path, f=X._finish: f(spark, path) if not calls.append(1) and len(calls) == 1 else (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            X.compact_small(spark, mixed, 200_000, groups=groups)
    X.compact_small(spark, mixed, 200_000, groups=groups)
    assert spark.read.parquet(mixed).count() == rows and X.compact_small(spark, mixed, 50_000) == 0


def test_unpartitioned(spark, folder):
    spark.range(1000).repartition(12).write.parquet(folder)
    assert X.compact_small(spark, folder) == 12 and len(files(folder)) == 1 and spark.read.parquet(folder).count() == 1000
    assert X.compact_small(spark, folder) == 0


def test_ten_rows_rewrite_ten_slots(spark, folder):
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(minutes=i), float(i), "a") for i in range(2000)]
    sinks.upsert_measurements(spark.createDataFrame(rows, "time timestamp, value double, type string"), folder, slots=16)
    before = files(folder)
    sinks.upsert_measurements(spark.createDataFrame([(t, v + 1, k) for t, v, k in rows[:10]], "time timestamp, value double, type string"), folder, slots=16)
    gone = {os.path.dirname(f) for f in set(before) - set(files(folder))}
    assert 1 <= len(gone) <= 10 < len({os.path.dirname(f) for f in before})
    got = {r["time"]: r["value"] for r in spark.read.parquet(folder).collect()}
    assert got == {t: v + (i < 10) for i, (t, v, _) in enumerate(rows)}


def test_a_hot_day_is_several_files(spark, folder):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        day = F.when(F.col("id") % 10 == 0, 2).otherwise(1)
        df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.lit(2024).alias("year"), F.lit(1).alias("month"), day.alias("day"))
        sinks.write_daily(df.repartition(8), folder)
    finally:
        spark.conf.set(key, before)
    hot = [f for f in files(folder) if "day=1/" in f]
    assert len(hot) > 3 and spark.read.parquet(folder).count() == 60_000
