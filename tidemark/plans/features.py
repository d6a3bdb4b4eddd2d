"""The features that training and serving share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cyclic, date_of, hour_of, is_weekend, weekday
from ..operators.joins import HOUR_KEYS, with_load_features
from ..operators.windows import lags_and_means, time_lags, time_trailing_mean

LOAD = "consumption_mwh_area"


def calendar_features(df: DataFrame) -> DataFrame:
    """Cyclical hour and day of year, day of week (0 Sunday) and weekend, from year, month, day, hour."""
    day = date_of("year", "month", "day")
    hour_sin, hour_cos = cyclic("hour", 24)
    year_sin, year_cos = cyclic(F.dayofyear(day), 365)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "day_of_year_sin": year_sin, "day_of_year_cos": year_cos, "day_of_week": weekday(day), "is_weekend": is_weekend(day)})


def load_features(load: DataFrame, by_time: bool = False) -> DataFrame:
    """Lags of 72 and 168 and the means before the current hour over as many, by rows or, past gaps, by hours. Rows without a load are left out."""
    df = load.filter(F.col(LOAD).isNotNull()).withColumn("ts", hour_of())
    if by_time:
        df = time_lags(df, LOAD, [72, 168])
        df = time_trailing_mean(time_trailing_mean(df, LOAD, 72, "load_mean_72h"), LOAD, 168, "load_mean_7d")
    else:
        df = lags_and_means(df, LOAD, [72, 168], {"load_mean_72h": 72, "load_mean_7d": 168})
    return df.drop("ts")


def serving_features(weather: DataFrame, load: DataFrame, by_time: bool = False) -> DataFrame:
    """Weather rows with calendar features and the load features of their area and hour."""
    lags = load_features(load, by_time).drop(LOAD)
    return with_load_features(calendar_features(weather), lags, HOUR_KEYS)
