from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import streaming as T
from tidemark.sources import read_energy, station_dim

SCHEMA = "station_id string, parameter_id string, t string, value double"


def feed(spark, folder, batches):
    """A stream that takes one file to a batch."""
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(folder)
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(folder)
    return raw.withColumn("ts", F.to_timestamp("t")).drop("t")


def temp(at, value=1.0, station="05005"):
    return (station, "temp_dry", f"2024-01-01 {at}", value)


def run(spark, folder, batches):
    out = T.area_stream(feed(spark, folder, batches), station_dim(spark), ("temp_dry", "wind_max"))
    T.start(out.writeStream.format("parquet").option("path", folder + "-out"), folder + "-state", once=True).awaitTermination()
    return {(r.dk_area, r.bucket.minute): (r.temp_dry, r.n_stations) for r in spark.read.schema(out.schema).parquet(folder + "-out").collect()}


def test_bucket_closes_twenty_minutes_after_its_end(spark, folder):
    assert run(spark, folder, [[temp("10:01:00"), temp("10:29:59")]]) == {}


def test_bucket_closes_and_late_rows_are_dropped(spark, folder):
    rows = [[temp("10:01:00", 1.0), temp("10:02:00", 3.0), temp("10:03:00", 8.0, "05009")], [temp("10:30:00")], [temp("10:41:00")], [temp("10:05:00", 100.0)]]
    assert run(spark, folder, rows)[("DK1", 0)] == (5.0, 2)


def test_live_series_adds_up_and_skips_what_was_sent_twice(spark, folder):
    rows = [('{"timestamp": "2024-01-01T00:00:00Z", "value": 0, "ShareMWh": 5, "PriceArea": "DK1", "id": 1}',)] * 2
    rows += [('{"timestamp": "", "HourUTC": "2024-01-01T00:00:00Z", "value": 2, "dk_area": "DK2", "id": 2}',), ('{"value": 3}',), ('{"timestamp": "2023-01-01T00:00:00Z", "value": 9}',)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.text(folder)
    now = datetime(2024, 1, 1, 1)
    for keys, want in ((None, 12.0), (["timestamp", "id"], 7.0)):
        raw = spark.readStream.text(folder)
        points = T.message_points(raw, "actual")
        if keys:
            points = T.message_points(raw.select("value"), "actual").withColumn("id", F.col("dk_area"))
        out = T.live_series(points, keys, now=now)
        name = f"live{len(keys or ())}"
        T.start(out.writeStream.format("memory").outputMode("update"), folder + name, once=True, name=name).awaitTermination()
        got = spark.table(name).collect()
        assert [(r.value, r.dk_area) for r in got] == [(want, "DK1")]
        assert T.newest_points(spark.table(name), 1).count() == 1


def test_predicted_messages(spark):
    rows = [('{"timestamp": "2024-01-01T00:00:00Z", "predictions": {"consumption_mwh": 4, "net_balance_mwh": -1}}',), ('{"timestamp": "2024-01-01T01:00:00Z"}',)]
    got = T.message_points(spark.createDataFrame(rows, "value string"), "predicted").orderBy("timestamp").collect()
    assert [(r.value, r.net_balance) for r in got] == [(4.0, -1.0), (0.0, 0.0)]


def test_landing_and_writing_once(spark, folder):
    stream = feed(spark, folder, [[temp("23:59:59")], [temp("10:00:00")]])
    T.land_observations(stream, folder + "-day", folder + "-s1", once=True).awaitTermination()
    assert spark.read.parquet(folder + "-day").select("year", "month", "day").distinct().count() == 1
    T.land_energy(stream, folder + "-month", folder + "-s2", once=True).awaitTermination()
    T.land_predictions(stream, folder + "-json", folder + "-s3", once=True).awaitTermination()
    assert spark.read.parquet(folder + "-month").count() == spark.read.json(folder + "-json").count() == 2
    assert read_energy(spark, folder + "-month", since=datetime(2024, 1, 1)).count() == 0  # no HourDK in these rows
    energy = spark.createDataFrame([(t,) for t in ("2024-01-31 23:00:00", "2024-02-10 10:00:00", "2024-02-20 00:00:00")], "t string").withColumn("ts", F.to_timestamp("t"))
    energy.withColumn("HourDK", F.unix_micros("ts") * 1000).select("HourDK", "ts").coalesce(1).write.parquet(folder + "-e")
    source = spark.readStream.schema("HourDK long, ts timestamp").parquet(folder + "-e")
    T.land_energy(source, folder + "-landed", folder + "-s6", once=True).awaitTermination()
    assert sorted(r.ts.day for r in read_energy(spark, folder + "-landed", since=datetime(2024, 2, 10, 5)).collect()) == [10, 20]
    sink = T.write_new(folder + "-new", ["station_id", "ts"], fresh="10 hours", ts="ts", now=datetime(2024, 1, 2))
    for state in ("-s4", "-s5"):  # the second query sees the same rows again
        T.start(stream.writeStream.foreachBatch(sink), folder + state, once=True).awaitTermination()
    assert spark.read.parquet(folder + "-new").count() == 1


def test_a_query_runs_at_its_pace(spark, folder):
    stream = feed(spark, folder, [[temp("10:00:00")], [temp("10:01:00")]])
    query = T.start(stream.writeStream.format("parquet").option("path", folder + "-out"), folder + "-state", every="1 second", name="paced")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(folder + "-out").count() == 2 and query.name == "paced"


def test_same_observation_twice(spark, folder):
    stream = feed(spark, folder, [[temp("10:00:00"), temp("10:00:00"), temp("10:01:00")]])
    T.start(T.dedup_stream(stream).writeStream.format("parquet").option("path", folder + "-out"), folder + "-state", once=True).awaitTermination()
    assert spark.read.parquet(folder + "-out").count() == 2


def test_hydrate(spark):
    rows = [("2024-01-01 00:00:00", 1.0, "actual"), ("2024-01-03 00:00:00", 2.0, "actual"), ("2024-01-03 01:00:00", 3.0, "predicted")]
    meas = spark.createDataFrame(rows, "t string, value double, type string").withColumn("time", F.to_timestamp("t"))
    assert sorted(r.value for r in T.hydrate(meas, now=datetime(2024, 1, 3, 2)).collect()) == [2.0, 3.0]


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.mark.parametrize("name", ["stream_late_rows", "stream_area_buckets", "stream_without_repeats"])
def test_a_large_part_is_several_batches_in_order(spark, folder, monkeypatch, name):
    """No batch holds a whole table, and none of its rows is late because of that: the result is the SQL's."""
    import duckdb

    from tidemark.plans import queries
    from tidemark.plans.registry import ORACLES, QUERIES

    monkeypatch.setattr(queries, "BATCH_ROWS", 100, raising=False)
    monkeypatch.setattr("tidemark.plans.roundtrips.BATCH_ROWS", 25, raising=False)
    started = []
    real = T.start
    monkeypatch.setattr(T, "start", lambda *a, **k: started.append(real(*a, **k)) or started[-1])
    kinds = ("click", "error", "purchase", "signup", "view")
    at = lambda i: datetime(2024, 1, 1) + timedelta(minutes=i * 7919 % 14400)  # noqa: E731  (ten days, out of order)
    data = [(i, at(i // 3), i % 9, kinds[i % 5], float(i % 40), None) for i in range(400)]
    spark.createDataFrame(data, EVENTS).repartition(3).write.parquet(folder + "/events.parquet")
    got = QUERIES[name](spark, folder).collect()
    batches = [p["numInputRows"] for p in started[0].recentProgress if p["numInputRows"]]
    assert len(batches) >= 4 and max(batches) < 200  # ranges are drawn from a sample
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want = db.execute(ORACLES[name]).fetchall()
    assert want and sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
