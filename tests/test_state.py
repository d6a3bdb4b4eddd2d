import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import streaming as T
from tidemark.streaming import ledger as L
from tidemark.streaming import state as A

T0 = datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp, value double, production double, net_balance double, dk_area string, type string, offset long"


def in_batches(spark, path, batches, schema):
    """A stream of a file to a batch, in order."""
    for i, rows in enumerate(batches):
        part = f"{path}-part{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(part)
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        os.makedirs(path, exist_ok=True)
        os.rename(f"{part}/{name}", f"{path}/{i:03d}.parquet")
        os.utime(f"{path}/{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("shards", [1, 3])
def test_live_points_over_batches(spark, folder, shards):
    """Sums go on over batches, the first area stays, and only the newest are kept, also when an old point changes late."""
    at = lambda h: T0 + timedelta(hours=h)
    batches = [
        [(at(h), float(h), 1.0, None, "DK1", "actual", h) for h in range(10)] + [(at(3), 5.0, 0.0, 0.5, "DK2", "actual", 11)],
        [(at(9), 100.0, 0.0, 0.0, "DK2", "actual", 20), (at(12), 1.0, 0.0, 0.0, None, "actual", 21), (at(0), 1.0, 1.0, 1.0, "DK2", "predicted", 22)],
        [(at(12), 2.0, 0.0, 0.0, "DK1", "actual", 30), (at(9), 1.0, 0.0, 0.0, "DK2", "actual", 31), (at(1), 7.0, 0.0, 0.0, "DK2", "actual", 32)],
    ]
    stream = in_batches(spark, folder, batches, SCHEMA)
    out = A.live_points(stream, "offset", most=4, shards=shards, now=at(13))
    name = f"live_points_{shards}"
    A.take_all(out.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", folder + "-state"))
    got = {(r["type"], r["timestamp"]): (r["value"], r["production"], r["net_balance"], r["dk_area"], r["n"]) for r in A.newest_live(spark.table(name), 4).collect()}
    assert got == {
        ("actual", at(12)): (3.0, 0.0, 0.0, None, 2),
        ("actual", at(9)): (110.0, 1.0, 0.0, "DK1", 3),
        ("actual", at(8)): (8.0, 1.0, 0.0, "DK1", 1),
        ("actual", at(7)): (7.0, 1.0, 0.0, "DK1", 1),
        ("predicted", at(0)): (1.0, 1.0, 1.0, "DK2", 1),
    }


def test_runs_after_events_and_idle_times(spark, folder):
    """A burst of events is one run, those within the gap start none, and a pause brings runs of its own."""
    rows = spark.createDataFrame([("weather",)] * 50 + [(None,)], "topic string")
    rows.write.mode("append").parquet(folder)
    events = spark.readStream.schema("topic string").parquet(folder)
    called = []
    query = A.start_runs(A.runs(events, gap="20 seconds", idle="22 seconds"), lambda topic, reason: called.append((topic, reason, time.time())), folder + "-state", "500 milliseconds")
    try:
        ends = time.time() + 70
        while time.time() < ends and not called:
            time.sleep(0.2)
        rows.limit(3).write.mode("append").parquet(folder)  # within the gap
        while time.time() < ends and len(called) < 2:
            time.sleep(0.2)
        rows.limit(3).write.mode("append").parquet(folder)  # within the gap of the idle run
        time.sleep(3)
    finally:
        query.stop()
    assert [c[:2] for c in called] == [("weather", "event"), ("weather", "idle")]
    assert called[1][2] - called[0][2] >= 10


ROWS = "dk_area string, year int, month int, day int, hour int, v double"


def batch_of(spark, hours, v=1.0):
    return spark.createDataFrame([("DK1", 2024, 1, 1 + h % 3, h, v) for h in hours], ROWS)


KEYS, DAY = ["dk_area", "year", "month", "day", "hour"], ["year", "month", "day"]


def test_a_batch_is_stored_once(spark, folder):
    write = L.write_once(folder, KEYS, DAY)
    write(batch_of(spark, [0, 1, 2, 2]), 0)
    write(batch_of(spark, [0, 1, 2]), 0)
    write(batch_of(spark, [7, 7]).unionByName(batch_of(spark, [7], 5.0)), 1)
    got = sorted((r["hour"], r["v"]) for r in spark.read.parquet(folder).collect())
    assert got == [(0, 1.0), (1, 1.0), (2, 1.0), (7, 5.0)]
    assert spark.read.parquet(folder).columns == ["dk_area", "hour", "v", "year", "month", "day"]


@pytest.mark.parametrize("dies", ["before the intent", "at the second file", "before the entry"])
def test_a_batch_that_dies_is_carried_on(spark, folder, monkeypatch, dies):
    write = L.write_once(folder, KEYS, DAY)
    write(batch_of(spark, [20]), 0)
    rows = batch_of(spark, range(9))
    with monkeypatch.context() as m:
        calls = []

        def fail(*a):
            raise KeyboardInterrupt

        def second(self, fs, source, target, move=L.Ledger._move):
            calls.append(target)
            if len(calls) == 2:
                raise KeyboardInterrupt
            move(self, fs, source, target)

        if dies == "before the intent":
            m.setattr(L, "_write_text", fail)
        elif dies == "at the second file":
            m.setattr(L.Ledger, "_move", second)
        else:
            m.setattr(L, "remove", lambda spark, path, r=L.remove: fail() if "_staging" in path and calls else (calls.append(1), r(spark, path)))
        with pytest.raises(KeyboardInterrupt):
            write(rows, 1)
    write(rows, 1)
    write(rows, 1)
    assert sorted(r["hour"] for r in spark.read.parquet(folder).collect()) == [*range(9), 20]
    assert not L.Ledger(spark, folder).write(rows, 1, DAY)


def test_stream_into_the_ledger(spark, folder):
    stream = in_batches(spark, folder + "-in", [[("DK1", 2024, 1, 1, h, float(b)) for h in (b, b + 1)] for b in range(3)], ROWS)
    for state in ("a", "b"):  # the second stream starts anew under the same name, as after a lost checkpoint: its batches are known
        stream.writeStream.foreachBatch(L.write_once(folder, KEYS, DAY)).option("checkpointLocation", folder + state).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(folder).count() == 6


def test_write_new_reads_the_days_of_the_batch_only(spark, folder):
    with pytest.raises(ValueError):
        T.write_new(folder, ["dk_area"], ["day"])
    write = T.write_new(folder, KEYS)
    for rows in ([0, 1, 1], [1, 2]):
        write(batch_of(spark, rows), 0)
    assert sorted(r["hour"] for r in spark.read.parquet(folder).collect()) == [0, 1, 2]
    assert spark.read.parquet(folder).filter(F.col("day") == 2).count() == 1
