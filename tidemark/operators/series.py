"""Queries on measurements: meas(time, value, type)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bucket_width, named_range, time_bucket, variance_pct
from .filters import between_time, check_range, interval, newer_than

ROLLUPS = ("5 minutes", "1 hour", "1 day")


def of_series(meas: DataFrame, series: str | None) -> DataFrame:
    return meas if series is None else meas.filter(F.col("type") == series)


def historical(meas: DataFrame, start: datetime | None = None, end: datetime | None = None, series: str | None = None, width: str | None = None, range: str | None = None, now: datetime | None = None) -> DataFrame:
    """Mean, least, greatest and count for each bucket and series of [start, end), in order of time.

    Without a width it follows the range; a named range such as '1d' ends at now.
    """
    if range:
        start, end = named_range(range, now)
    check_range(start, end)
    df = of_series(between_time(meas, "time", start, end), series)
    return bucket_stats(df, width or bucket_width(start, end)).orderBy("timestamp", "type")


def bucket_stats(meas: DataFrame, width: str) -> DataFrame:
    return meas.groupBy(time_bucket("time", width).alias("timestamp"), "type").agg(F.avg("value").alias("value"), F.min("value").alias("min"), F.max("value").alias("max"), F.count("*").alias("count"))


def stats(meas: DataFrame, start: datetime, end: datetime, series: str | None = None) -> DataFrame:
    """Mean, least, greatest, sample deviation (null for one row) and count for each series."""
    df = of_series(between_time(meas, "time", start, end), series)
    return df.groupBy("type").agg(F.avg("value").alias("avg"), F.min("value").alias("min"), F.max("value").alias("max"), F.stddev_samp("value").alias("stddev"), F.count("*").alias("count"))


def rollup(meas: DataFrame, width: str) -> DataFrame:
    """Stored buckets. They keep the sum beside the count, so coarser ones can be made of them without averaging averages."""
    return meas.groupBy(time_bucket("time", width).alias("bucket"), "type").agg(
        F.sum("value").alias("sum"), F.count("value").alias("count"), F.min("value").alias("min"), F.max("value").alias("max")
    ).withColumn("avg", F.col("sum") / F.col("count"))


def coarser(rolled: DataFrame, width: str) -> DataFrame:
    """A roll-up of a roll-up."""
    return rolled.groupBy(time_bucket("bucket", width).alias("bucket"), "type").agg(
        F.sum("sum").alias("sum"), F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max")
    ).withColumn("avg", F.col("sum") / F.col("count"))


def refresh_rollup(existing: DataFrame, meas: DataFrame, start: datetime, end: datetime, width: str) -> DataFrame:
    """existing with the buckets of [start, end) made anew; start and end must be bounds of buckets. RollupStore does it for what is stored."""
    check_range(start, end)
    if any((t - datetime(1970, 1, 1)) % interval(width) for t in (start, end)):
        raise ValueError(f"start and end must be bounds of buckets of {width}")
    kept = existing.filter((F.col("bucket") < F.lit(start)) | (F.col("bucket") >= F.lit(end)))
    return kept.unionByName(rollup(between_time(meas, "time", start, end), width).select(*existing.columns))


def align_series(meas: DataFrame, series: tuple[str, ...] = ("actual", "predicted"), by: Column | None = None) -> DataFrame:
    """One row for each time with a column for each series; a missing side is null."""
    ts = (by if by is not None else F.col("time")).alias("timestamp")
    return meas.groupBy(ts).pivot("type", list(series)).agg(F.avg("value"))


def kpis(aligned: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Mean and last value of each series, and how far the last pair is apart in percent."""
    out = aligned.agg(
        F.avg(actual).alias("actual_mean"),
        F.avg(predicted).alias("predicted_mean"),
        F.max_by(actual, F.when(F.col(actual).isNotNull(), F.col("timestamp"))).alias("actual_last"),
        F.max_by(predicted, F.when(F.col(predicted).isNotNull(), F.col("timestamp"))).alias("predicted_last"),
    )
    return out.withColumn("variance_pct", variance_pct("predicted_last", "actual_last"))


def newest(df: DataFrame, by: list[str], n: int = 100, ts: str = "time", ties: tuple[str, ...] = ()) -> DataFrame:
    """The newest n rows of each group; ties break by the columns given, greatest first."""
    w = Window.partitionBy(*by).orderBy(F.col(ts).desc(), *[F.col(c).desc() for c in ties])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def latest_points(meas: DataFrame, series: str, n: int = 100, now: datetime | None = None, within: str = "48 hours", ties: tuple[str, ...] = ()) -> DataFrame:
    """Of a series' newest n points those within a span, in order of time; ties break by the columns given, or all others, greatest first."""
    ties = ties or tuple(c for c in meas.columns if c != "time")
    top = of_series(meas, series).orderBy(F.col("time").desc(), *[F.col(c).desc() for c in ties]).limit(n)
    return newer_than(top, "time", within, now).orderBy("time")


def top_newest(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in keys]).limit(n)


def latest_per_key(meas: DataFrame, keys: tuple[str, ...] = ("time", "type"), order: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key, the last by order, or by all other columns."""
    order = order or tuple(c for c in meas.columns if c not in keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return meas.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
