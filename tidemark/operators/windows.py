"""Lags and trailing statistics of hourly series.

Windows of rows and of time run over slices of a series (see slices): about slice_rows rows, or a span of time, to a task. slice_rows=None or span=None runs one
window over each series instead, for short ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from .slices import SLICE_ROWS, over_rows, over_time


def row_lags(df: DataFrame, value: str, lags: list[int], by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """The value so many rows before, whatever the gaps."""
    return over_rows(df, by, ts, max(lags), lambda d, w: d.withColumns({f"load_lag_{k}": F.lag(value, k).over(w) for k in lags}), slice_rows)


def trailing_means(df: DataFrame, value: str, names: dict[str, int], by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """For each name the mean of so many rows before the current one."""
    return over_rows(df, by, ts, max(names.values()), lambda d, w: d.withColumns({k: F.avg(value).over(w.rowsBetween(-n, -1)) for k, n in names.items()}), slice_rows)


def trailing_mean(df: DataFrame, value: str, n: int, name: str, by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """The mean of the n rows before the current one."""
    return trailing_means(df, value, {name: n}, by, ts, slice_rows)


def lags_and_means(df: DataFrame, value: str, lags: list[int], means: dict[str, int], by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """row_lags and trailing_means, with the series sliced once."""

    def compute(d: DataFrame, w: WindowSpec) -> DataFrame:
        old = {f"load_lag_{k}": F.lag(value, k).over(w) for k in lags}
        return d.withColumns(old | {k: F.avg(value).over(w.rowsBetween(-n, -1)) for k, n in means.items()})

    return over_rows(df, by, ts, max(*lags, *means.values()), compute, slice_rows)


def time_lags(df: DataFrame, value: str, lags: list[int], by: str = "dk_area", ts: str = "ts") -> DataFrame:
    """The value so many hours before; null where that hour is missing. A join on the shifted time, so no sort of a whole area."""
    out = df
    for k in lags:
        old = df.select(by, (F.col(ts) + F.expr(f"INTERVAL {k} HOURS")).alias(ts), F.col(value).alias(f"load_lag_{k}"))
        out = out.join(old, [by, ts], "left")
    return out


def time_trailing_mean(df: DataFrame, value: str, hours: int, name: str, by: str = "dk_area", ts: str = "ts", span: str | None = "90 days") -> DataFrame:
    """The mean over the hours before the current one, by time."""
    return over_time(df, by, ts, f"{hours} hours", lambda d, w: d.withColumn(name, F.avg(value).over(w.rangeBetween(-hours * 3600, -1))), span)


def _lagged(d: DataFrame, w: WindowSpec, value: str, lags: tuple[int, ...]) -> DataFrame:
    return d.withColumns({f"{value}_lag_{k}": F.lag(value, k).over(w) for k in lags})


def _rolled(d: DataFrame, w: WindowSpec, value: str, windows: tuple[int, ...]) -> DataFrame:
    out = {}
    for n in windows:
        before = w.rowsBetween(-n, -1)
        out |= {f"{value}_mean_{n}": F.avg(value).over(before), f"{value}_std_{n}": F.stddev_samp(value).over(before)}
    return d.withColumns(out)


def lag_features(df: DataFrame, value: str, lags: tuple[int, ...] = (1, 2, 24), by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    return over_rows(df, by, ts, max(lags), lambda d, w: _lagged(d, w, value, lags), slice_rows)


def rolling_stats(df: DataFrame, value: str, windows: tuple[int, ...] = (3, 24, 168), by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """Mean and sample deviation of the n rows before the current one, for each n."""
    return over_rows(df, by, ts, max(windows), lambda d, w: _rolled(d, w, value, windows), slice_rows)


def row_features(df: DataFrame, value: str, lags: tuple[int, ...] = (1, 2, 24), windows: tuple[int, ...] = (3, 24, 168), by: str = "dk_area", ts: str = "ts", slice_rows: int | None = SLICE_ROWS) -> DataFrame:
    """lag_features and rolling_stats, with the series sliced once."""
    return over_rows(df, by, ts, max(*lags, *windows), lambda d, w: _rolled(_lagged(d, w, value, lags), w, value, windows), slice_rows)
