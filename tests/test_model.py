from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.plans import features, model
from tidemark.operators.joins import BUCKET_KEYS, HOUR_KEYS, training_frame

KEYS = "dk_area string, year int, month int, day int, hour int"


def test_split(spark):
    rows = [("DK1", 2023, 1), ("DK2", 2023, 1), ("DK1", 2024, 1), ("DK1", 2025, 1), ("DK1", 2025, 11)]
    load = spark.createDataFrame([(a, y, m, 1, 12, 1000.0) for a, y, m in rows], KEYS + ", consumption_mwh_area double")
    frame = training_frame(load.select(*HOUR_KEYS, F.lit(5.0).alias("temp_dry")), load)
    assert [p.count() for p in model.time_split(frame)] == [3, 1, 1]
    late = frame.filter("year > 2024")
    assert sum(p.count() for p in model.time_split(late)) == 2


def frame(spark, n=200):
    df = spark.range(n).withColumn("ts", F.timestamp_seconds(1704067200 + F.col("id") * 3600))
    return df.select(
        F.lit("DK1").alias("dk_area"), F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"), F.hour("ts").alias("hour"), "ts",
        F.when(F.col("id") % 9 == 0, float("nan")).when(F.col("id") % 10 == 0, None).otherwise((F.col("id") % 24).cast("double")).alias("temp_dry"),
        F.lit(None).cast("double").alias("temp_soil"), (F.lit(500.0) + 10 * F.hour("ts")).alias("consumption_mwh_area"),
    )


def test_fit_score_save(spark, folder):
    df = frame(spark)
    fitted = model.fit_load_model(df, weather=("temp_dry", "temp_soil"), trees=5, depth=5)
    keys = [*HOUR_KEYS, "consumption_mwh_area"]
    scored = model.score(fitted, df, keys)
    assert scored.count() == 200
    quality = model.evaluate(scored)
    assert quality["r2"] > 0.8 and quality["rmse"] >= quality["mae"] > 0
    model.save_model(fitted, folder, now=datetime(2024, 1, 1))
    model.save_model(fitted, folder, now=datetime(2024, 1, 2), archive=folder + "/archive")
    again = model.score(model.load_latest_model(spark, folder), df, keys)
    assert again.exceptAll(scored).count() == 0
    with pytest.raises(FileNotFoundError):
        model.load_latest_model(spark, folder, "other")


def test_fractions(spark):
    parts = model.fraction_split(frame(spark), "ts", error=0.0)
    counts = [p.count() for p in parts]
    assert sum(counts) == 200 and all(abs(c - n) <= 2 for c, n in zip(counts, (140, 30, 30), strict=True))


def test_tune(spark):
    best = model.tune(frame(spark), "consumption_mwh_area", ["hour", "temp_dry"], depths=(2,), rounds=(3,))
    assert best.transform(frame(spark)).count() == 200


def test_features(spark):
    load = frame(spark).select(*HOUR_KEYS, "consumption_mwh_area")
    out = features.serving_features(load.drop("consumption_mwh_area"), load)
    r = out.filter("day = 8 and hour = 5").first()
    assert r.load_lag_72 == 550.0 and r.load_lag_168 == 550.0 and r.day_of_week == 1 and r.is_weekend == 0
    by_time = features.serving_features(load.drop("consumption_mwh_area"), load, by_time=True)
    assert by_time.select(*out.columns).exceptAll(out).count() == 0


def test_messages(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "DK1", 1.0), ("2024-01-01 00:00:00", "DK2", 2.0)], "t string, dk_area string, prediction double")
    got = model.prediction_messages(rows.withColumn("ts", F.to_timestamp("t"))).collect()
    assert len(got) == 1 and got[0].key == "DK_2024-01-01 00:00:00"
    assert got[0].value == '{"timestamp":"2024-01-01T00:00:00Z","dk_area":"DK","predictions":{"consumption_mwh":3.0,"production_mwh":0.0,"net_balance_mwh":0.0}}'
    assert "minute_bucket" in BUCKET_KEYS


def test_tune_by_time(spark):
    """The newest fifth decides; a load that follows the hour takes the deeper trees."""
    df = frame(spark, 400).withColumn("consumption_mwh_area", F.col("hour").cast("double"))
    best = model.tune(df, "consumption_mwh_area", ["hour"], depths=(1, 4), rounds=(2,), by="ts")
    assert best.stages[-1].trees[0].depth == 4 and best.transform(df).count() == 400


def test_learned(spark):
    df = spark.createDataFrame([(1.0, 2, 5.0), (None, 4, 6.0), (float("nan"), 6, 7.0), (3.0, 8, 8.0)], "x double, month int, consumption_mwh_area double")
    got = {r.feature: r for r in model.learned(model.fit_load_model(df, weather=("x",), calendar=("month",), trees=1, depth=1)).collect()}
    assert got["x"].fill == 2.0 and got["x"].mean == 2.0 and got["x"].deviation == pytest.approx((2 / 3) ** 0.5)
    assert got["month"].fill is None and got["month"].mean == 5.0


def test_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0), (None, 1.0)], "y double, prediction double")
    got = model.evaluate(df, "y")
    assert got == pytest.approx({"rmse": (10 / 3) ** 0.5, "mae": 4 / 3, "r2": 1 - 10 / 8})
    assert all(v != v for v in model.evaluate(df.limit(0), "y").values())
    same = model.evaluate(df.filter("y = 3"), "y")
    assert same["rmse"] == 0.0 and same["r2"] != same["r2"]
