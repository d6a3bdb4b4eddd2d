from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.fixed import DK1_STATIONS, DK2_STATIONS, HOURLY_PARAMETERS, STATION_NAMES, WEATHER_FEATURES
from tidemark.operators import aggregates as A
from tidemark.operators import filters as P
from tidemark.operators import joins as J
from tidemark.operators import maintenance as X
from tidemark.operators import series as S
from tidemark.operators import sinks
from tidemark.operators import windows as W
from tidemark.sources import (
    FEATURES,
    RECORDS,
    day_pruning,
    decode_value,
    dimension,
    normalize_energy,
    normalize_features,
    read_energy,
    read_history,
    read_observations,
    station_dim,
    station_names,
)


def obs(spark, rows):
    df = spark.createDataFrame(rows, "station_id string, parameter_id string, ts string, value double")
    return df.withColumn("ts", F.to_timestamp("ts"))


def test_vocabularies(spark):
    assert (len(DK1_STATIONS), len(DK2_STATIONS), len(HOURLY_PARAMETERS), len(WEATHER_FEATURES)) == (99, 41, 22, 21)
    assert not set(DK1_STATIONS) & set(DK2_STATIONS)
    assert station_dim(spark).count() == 140
    assert set(STATION_NAMES) - set(DK1_STATIONS) - set(DK2_STATIONS) <= set(STATION_NAMES) and station_names(spark).count() == 57


def test_ten_minute_means(spark):
    rows = [
        ("06180", "temp_dry", "2023-10-27 10:05:00", 15.0),
        ("06180", "temp_dry", "2023-10-27 10:08:00", 16.0),
        ("06180", "wind_speed", "2023-10-27 10:05:00", 5.0),
        ("05005", "temp_dry", "2023-10-27 10:02:00", 10.0),
        ("05005", "temp_dry", "2023-10-27 10:09:00", 12.0),
        ("99999", "temp_dry", "2023-10-27 10:09:00", 99.0),
    ]
    out = A.area_buckets(obs(spark, rows), station_dim(spark), "10min", ("temp_dry", "wind_speed", "wind_max"))
    got = {r.dk_area: (r.minute_bucket, r.temp_dry, r.wind_speed, r.wind_max, r.n_stations) for r in out.collect()}
    assert got == {"DK2": (0, 15.5, 5.0, None, 1), "DK1": (0, 11.0, None, None, 1)}


def test_means_of_means_are_not_means(spark):
    rows = [("05005", "temp_dry", f"2024-01-01 00:0{i % 10}:00", 10.0) for i in range(10)] + [("05009", "temp_dry", "2024-01-01 00:01:00", 21.0)]
    df = obs(spark, rows)
    assert A.area_buckets(df, station_dim(spark), "hour", ("temp_dry",)).first().temp_dry == 15.5
    view = A.area_hourly_view(J.with_area(df, station_dim(spark))).first()
    assert view.temp_mean_area == 11.0 and view.n_stations == 2 and view.temp_soil_mean_area is None


def test_buckets_at_their_edges(spark):
    rows = [("05005", "temp_dry", t, 1.0) for t in ("2024-01-01 10:09:59.999", "2024-01-01 10:10:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00")]
    got = A.area_buckets(obs(spark, rows), station_dim(spark), "10min", ("temp_dry",)).select("day", "hour", "minute_bucket").collect()
    assert sorted(map(tuple, got)) == [(1, 10, 0), (1, 10, 10), (1, 23, 50), (2, 0, 0)]


def test_direction(spark):
    rows = [("05005", "wind_dir", "2024-01-01 00:00:00", 350.0), ("05009", "wind_dir", "2024-01-01 00:00:00", 10.0)]
    r = A.area_buckets(obs(spark, rows), station_dim(spark), "hour", ("wind_dir",), direction="wind_dir").first()
    assert r.wind_dir_sin == pytest.approx(0, abs=1e-12) and r.wind_dir_cos == pytest.approx(0.98480775)


def test_empty(spark):
    df = obs(spark, [])
    assert A.area_buckets(df, station_dim(spark), "hour", ("temp_dry",)).count() == 0
    assert A.profile_columns(df, ["value"]).first().missing_pct is None
    assert not A.has_rows(df) and A.latest_time(df).first().latest is None


def test_profile(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), None), (0.0, None), (None, None)], "a double, b double")
    got = {r.column: (r.n, r.n_missing, r.n_zero, r.missing_pct, r.all_missing) for r in A.profile_columns(df, ["a", "b"]).collect()}
    assert got == {"a": (4, 2, 1, 50.0, False), "b": (4, 4, 0, 100.0, True)}
    mixed = spark.createDataFrame([("0", 0, True), (None, 1, None)], "t string, i int, f boolean")
    got = {r.column: (r.n_missing, r.n_zero) for r in A.profile_columns(mixed, ["t", "i", "f"]).collect()}
    assert got == {"t": (1, 0), "i": (0, 1), "f": (1, 0)}
    stored = A.to_store(spark.createDataFrame([("DK1", 5, 1.0)], "dk_area string, hour int, temp_dry double"), ("temp_dry", "humidity"), ["dk_area", "hour"])
    assert stored.columns == ["temp_dry", "humidity", "n_stations", "predicted", "dk_area", "hour"] and stored.first().predicted == 0


def load(spark, hours):
    df = spark.createDataFrame([("DK1", h, float(v)) for h, v in hours], "dk_area string, h int, v double")
    return df.select("dk_area", (F.to_timestamp(F.lit("2024-01-01")) + F.make_dt_interval(hours=F.col("h"))).alias("ts"), "v")


def test_lags_over_a_gap(spark):
    df = load(spark, [(0, 1), (1, 2), (3, 4), (4, 5)])
    rows = W.row_lags(df, "v", [2]).orderBy("ts").select("load_lag_2").collect()
    times = W.time_lags(df, "v", [2]).orderBy("ts").select("load_lag_2").collect()
    assert [r[0] for r in rows] == [None, None, 1.0, 2.0]
    assert [r[0] for r in times] == [None, None, 2.0, None]
    means = W.time_trailing_mean(W.trailing_mean(df, "v", 2, "rows"), "v", 2, "hours").orderBy("ts").select("rows", "hours").collect()
    assert [tuple(r) for r in means] == [(None, None), (1.0, 1.0), (1.5, 2.0), (3.0, 4.0)]


def test_rolling(spark):
    r = W.rolling_stats(W.lag_features(load(spark, [(0, 1), (1, 3)]), "v", (1,)), "v", (3,)).orderBy("ts").collect()[1]
    assert (r.v_lag_1, r.v_mean_3, r.v_std_3) == (1.0, 1.0, None)


def meas(spark, rows):
    return spark.createDataFrame(rows, "t string, value double, type string").select(F.to_timestamp("t").alias("time"), "value", "type")


def test_history_and_stats(spark):
    df = meas(spark, [("2024-01-01 00:01:00", 1.0, "actual"), ("2024-01-01 00:04:00", 3.0, "actual"), ("2024-01-01 00:05:00", 7.0, "predicted"), ("2024-01-02 00:00:00", 9.0, "actual")])
    day = (datetime(2024, 1, 1), datetime(2024, 1, 2))
    got = [tuple(r)[1:] for r in S.historical(df, *day).collect()]
    assert got == [("actual", 2.0, 1.0, 3.0, 2), ("predicted", 7.0, 7.0, 7.0, 1)]
    assert S.historical(df, *day, series="predicted").count() == 1
    one = S.stats(df, *day, series="predicted").first()
    assert one.stddev is None and one["count"] == 1
    for bad in ((None, day[1]), (day[1], day[0])):
        with pytest.raises(ValueError):
            S.historical(df, *bad)


def test_rollups(spark):
    df = meas(spark, [("2024-01-01 00:01:00", 1.0, "a"), ("2024-01-01 00:02:00", 2.0, "a"), ("2024-01-01 00:31:00", 9.0, "a")])
    fine = S.rollup(df, "5 minutes")
    assert S.coarser(fine, "1 hour").first().avg == 4.0
    again = S.refresh_rollup(fine, df.withColumn("value", F.col("value") + 1), datetime(2024, 1, 1, 0, 30), datetime(2024, 1, 1, 1), "5 minutes")
    assert sorted(r["avg"] for r in again.collect()) == [1.5, 10.0]


def test_alignment(spark):
    df = meas(spark, [("2024-01-01 00:00:00", 80.0, "actual"), ("2024-01-01 00:00:00", 110.0, "predicted"), ("2024-01-01 01:00:00", 5.0, "predicted")])
    got = S.align_series(df)
    assert {(r.actual, r.predicted) for r in got.collect()} == {(80.0, 110.0), (None, 5.0)}
    k = S.kpis(got).first()
    assert (k.actual_last, k.predicted_last, k.variance_pct) == (80.0, 5.0, -93.8)


def test_newest(spark):
    df = meas(spark, [(f"2024-01-01 00:0{i}:00", float(i), t) for i in range(5) for t in ("a", "b")])
    assert {r.value for r in S.newest(df, ["type"], 2).collect()} == {3.0, 4.0}
    got = S.latest_points(df, "a", 3, datetime(2024, 1, 1, 1, 3), "1 hour").collect()
    assert [r.value for r in got] == [3.0, 4.0]


def test_filters(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("UNKNOWN", None)], "dk_area string, v double")
    assert P.known_area(df).count() == 1 and P.require(df, ["v"]).count() == 2
    assert P.conform(df, {"v": "string", "x": "int"}).dtypes == [("v", "string"), ("x", "int")]
    t = meas(spark, [("2024-01-01 00:00:00", 1.0, "a"), ("2024-01-02 00:00:00", 1.0, "a")])
    assert P.newer_than(t, "time", "24 hours", datetime(2024, 1, 2, 12)).count() == 1
    assert P.between_time(t, "time", datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 1


def test_anti_joins(spark):
    new = spark.createDataFrame([("DK1", 2024, 1, 1, h, m) for h in (0, 1) for m in (0, 10)], "dk_area string, year int, month int, day int, hour int, minute_bucket int")
    done = new.filter("hour = 0 and minute_bucket = 0")
    assert [(r.hour, r.minute_bucket) for r in J.unpredicted(new, done).collect()] == [(1, 10), (1, 0), (0, 10)]
    assert J.new_only(new, done).count() == 2


def test_stores_are_pruned_by_the_batch(spark, folder):
    rows = [("DK1", 2024, 1, day, h, m) for day in range(1, 6) for h in (0, 1) for m in (0, 10)]
    weather = spark.createDataFrame(rows, "dk_area string, year int, month int, day int, hour int, minute_bucket int")
    sinks.log_predictions(weather.filter("minute_bucket = 0"), folder)
    out = J.unpredicted(weather.filter("day = 3"), spark.read.parquet(folder))
    plan = out._jdf.queryExecution().toString()
    assert [(r.day, r.hour, r.minute_bucket) for r in out.collect()] == [(3, 1, 10), (3, 0, 10)]
    assert "day#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "3" in plan.split("PartitionFilters: [")[1].split("]")[0]
    store = spark.read.parquet(folder)
    assert P.partitions_of(store, weather, ["day"], most=2).count() == 10 and P.partitions_of(store, weather.limit(0), ["day"]).count() == 0


def write_observations(spark, folder):
    rows = [("05005", f"{d}T10:00:00Z", "temp_dry", 1.0, int(d[:4]), int(d[5:7]), int(d[8:])) for d in ("2020-12-31", "2023-12-31", "2024-01-01", "2024-01-02")]
    sinks.write_daily(spark.createDataFrame(rows, "stationId string, timeObserved string, parameterId string, value double, year int, month int, day int"), folder)


def test_observations_are_pruned(spark, folder):
    write_observations(spark, folder)
    df = read_observations(spark, folder, datetime(2023, 12, 31, 12), datetime(2024, 1, 2))
    assert [r.ts for r in df.collect()] == [datetime(2024, 1, 1, 10)]
    assert "PartitionFilters: [" in df._jdf.queryExecution().toString() and "(year" in df._jdf.queryExecution().toString()
    assert read_history(spark, folder).count() == 3
    assert day_pruning(None, None) is not None


def test_documents(spark):
    one = '{"features": [{"properties": {"stationId": "06180", "observed": "2023-05-01T00:00:00Z", "parameterId": "temp_dry", "value": 18.5}}, {"properties": {"stationId": "06180", "observed": "2023-05-01T00:00:00Z", "parameterId": null, "value": "invalid"}}]}'
    docs = spark.createDataFrame([(one,), ('{"features": []}',)], "j string").select(F.from_json("j", FEATURES).alias("d")).select("d.*")
    strict, loose = normalize_features(docs).collect(), normalize_features(docs, strict=False).collect()
    assert [(r.value, r.year, r.month) for r in strict] == [(18.5, 2023, 5)]
    assert [r.value for r in loose] == [18.5, None]


def test_energy(spark, folder):
    one = '{"records": [{"HourUTC": "2023-01-01T00:00:00Z", "HourDK": "2023-01-01T01:00:00", "PriceArea": "DK1", "ConnectedArea": "DK2", "ShareMWh": 150.5}]}'
    docs = spark.createDataFrame([(one,)], "j string").select(F.from_json("j", RECORDS).alias("d")).select("d.*")
    row = normalize_energy(docs).first()
    assert (row.year, row.month, row.PriceArea, row.ShareMWh, row.SharePPM) == (2023, 1, "DK1", 150.5, None)
    live = normalize_energy(docs, as_strings=True).first()
    assert live.ViaArea == "" and live.SharePPM is None and live.ShareMWh == 150.5
    normalize_energy(docs).unionByName(normalize_energy(docs)).write.partitionBy("year", "month", "day").parquet(folder)
    assert read_energy(spark, folder).first().ts == datetime(2023, 1, 1, 1)
    assert read_energy(spark, folder, local_zone="Europe/Copenhagen").first().ts == datetime(2023, 1, 1)
    assert read_energy(spark, folder, since=datetime(2024, 1, 1)).count() == 0
    assert A.consumption_hourly(read_energy(spark, folder)).first().consumption_mwh_area == 301.0


def test_messages(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", float("inf"), "x")], "s string, v double, n string")
    got = [tuple(r) for r in sinks.replay(df, ["station", "v", "none"], {"s": "station"}).collect()]
    assert got == [("a_1.0", '{"station":"a","v":1.0,"none":null}'), ("b", '{"station":"b","v":null,"none":null}')]
    raw = spark.createDataFrame([(b'{"x": 4}',)], "value binary")
    assert decode_value(raw, "x int").first().x == 4


def test_topics_go_through_the_stream_reader_and_writer():
    """There is no Kafka package here; what would be asked of it is noted by a stand-in."""
    asked = []

    class StandIn:
        def __getattr__(self, name):
            def call(*a, **k):
                asked.append((name, a, k))
                return self

            return call

        @property
        def readStream(self):
            return self

        @property
        def write(self):
            return self

    from tidemark.sources import read_topic

    read_topic(StandIn(), "weather", "host:1", maxOffsetsPerTrigger="5")
    sinks.publish(StandIn(), "out", "host:2")
    assert ("option", ("subscribe", "weather"), {}) in asked and ("options", (), {"maxOffsetsPerTrigger": "5"}) in asked
    assert ("option", ("topic", "out"), {}) in asked and [a[1] for a in asked if a[0] == "format"] == [("kafka",)] * 2


def test_avro_values_start_behind_their_head(spark, monkeypatch):
    """There is no Avro package here; a stand-in reads the body as JSON."""
    import pyspark.sql.avro.functions as avro

    monkeypatch.setattr(avro, "from_avro", lambda body, schema, options: F.from_json(body.cast("string"), "x int"))
    rows = spark.createDataFrame([(b'\x00\x00\x00\x00\x07{"x": 5}',), (b'{"x": 4}',), (b"\x00\x00",)], "value binary")
    assert [r.x for r in decode_value(rows, "x int", "{}").collect()] == [5, 4, None]


def test_upsert(spark, folder):
    first = meas(spark, [("2024-01-01 00:00:00", 1.0, "a"), ("2024-01-02 00:00:00", 2.0, "a")]).withColumn("n", F.lit(1))
    sinks.upsert_measurements(first, folder, ("n",))
    again = meas(spark, [("2024-01-01 00:00:00", 5.0, "a"), ("2024-01-01 01:00:00", 6.0, "a")]).withColumn("n", F.lit(2))
    sinks.upsert_measurements(again.unionByName(first.withColumn("n", F.lit(0))), folder, ("n",))
    got = sorted((r.time.day, r.time.hour, r.value) for r in spark.read.parquet(folder).collect())
    assert got == [(1, 0, 5.0), (1, 1, 6.0), (2, 0, 2.0)]


def test_upsert_without_an_order(spark, folder):
    first = meas(spark, [("2024-01-01 00:00:00", 1.0, "a"), ("2024-01-01 00:00:00", 4.0, "a"), ("2024-01-01 00:00:00", None, "b")])
    sinks.upsert_measurements(first, folder)
    sinks.upsert_measurements(meas(spark, [("2024-01-01 00:00:00", 3.0, "b")]), folder)
    assert sorted((r.type, r.value) for r in spark.read.parquet(folder).collect()) == [("a", 4.0), ("b", 3.0)]
    import os

    assert not [x for x in os.listdir(os.path.dirname(folder)) if "merging" in x]


def test_append_new(spark, folder):
    df = spark.createDataFrame([("DK1", 2024, 1, 1, h) for h in range(3)], "dk_area string, year int, month int, day int, hour int")
    for part in (df.filter("hour < 2"), df):
        sinks.append_new(part, folder, J.HOUR_KEYS, ["year", "month"])
    assert spark.read.parquet(folder).count() == 3


def test_compaction(spark, folder):
    df = spark.range(100).withColumn("k", F.col("id") % 2)
    df.repartition(12).write.parquet(folder)
    assert X.compact(spark, folder, 3) and not X.compact(spark, folder, 3)
    assert len(spark.read.parquet(folder).inputFiles()) == 3 and spark.read.parquet(folder).count() == 100
    parts = folder + "p"
    df.repartition(6).write.partitionBy("k").parquet(parts)
    assert X.compact(spark, parts, keys=["k"]) and len(spark.read.parquet(parts).inputFiles()) == 2
    X.rewrite_by(df.select("k", "id"), ["k"], folder + "r")
    assert spark.read.parquet(folder + "r").columns == ["id", "k"]


def test_retention(spark, folder):
    df = meas(spark, [("2022-01-01 00:00:00", 1.0, "a"), ("2024-01-01 00:00:00", 2.0, "a")]).withColumn("day", F.to_date("time"))
    df.write.partitionBy("day").parquet(folder)
    assert X.expire(spark, folder, "1 year", datetime(2024, 6, 1)) == 1
    assert [r.value for r in spark.read.parquet(folder).collect()] == [2.0]
    parts = df.withColumns({"year": F.year("time"), "month": F.month("time"), "day": F.day("time")})
    parts.write.partitionBy("year", "month", "day").parquet(folder + "-parts")
    assert X.expire(spark, folder + "-parts", "1 year", datetime(2024, 6, 1)) == 1 and spark.read.parquet(folder + "-parts").count() == 1
    parts.drop("day").write.partitionBy("year", "month").parquet(folder + "-months")
    assert X.expire(spark, folder + "-months", "1 day", datetime(2024, 1, 31)) == 1
    assert X.expire(spark, folder + "-months", "1 day", datetime(2024, 2, 2)) == 1


def test_dimension(spark, tmp_path):
    (tmp_path / "d.csv").write_text("id,name\n1,x\n")
    assert dimension(spark, str(tmp_path / "d.csv")).first().name == "x"
