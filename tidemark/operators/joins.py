"""Joins on areas, hours and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import partitions_of

HOUR_KEYS = ["dk_area", "year", "month", "day", "hour"]
BUCKET_KEYS = [*HOUR_KEYS, "minute_bucket"]
SMALL = 100_000


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; the count stops there."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def with_area(df: DataFrame, dim: DataFrame, key: str = "station_id") -> DataFrame:
    """Adds the area of the station; stations that dim doesn't know are dropped. A small dim is broadcast."""
    return df.join(small(dim), key)


def training_frame(weather: DataFrame, load: DataFrame) -> DataFrame:
    """Weather and consumption of the same area and hour."""
    return weather.join(load, HOUR_KEYS)


def with_load_features(weather: DataFrame, load: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every weather row, with the load features of its area and hour where there are some."""
    return weather.join(load, keys or HOUR_KEYS, "left")


def new_only(df: DataFrame, existing: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rows whose key isn't stored yet."""
    keys = keys or HOUR_KEYS
    return df.join(existing.select(*keys), keys, "left_anti")


def unpredicted(weather: DataFrame, done: DataFrame) -> DataFrame:
    """Buckets that the prediction log doesn't hold, newest first. Of the log only the days of weather are read."""
    return newest_first(new_only(weather, partitions_of(done, weather, HOUR_KEYS[1:4]), BUCKET_KEYS))


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in BUCKET_KEYS[1:]])
