"""Filters, and what brings a frame to a wanted shape."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800, "year": 365 * 86400}


def interval(text: str) -> timedelta:
    """'48 hours' and the like; a year has 365 days."""
    n, unit = text.split()
    return timedelta(seconds=float(n) * UNITS[unit.rstrip("s")])


def only_parameters(df: DataFrame, names: tuple[str, ...], column: str = "parameter_id") -> DataFrame:
    return df.filter(F.col(column).isin(*names))


def between_time(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """start <= ts < end."""
    return df.filter((F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(end)))


def prune_day(df: DataFrame, day: date) -> DataFrame:
    """The partition of a day."""
    return df.filter((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))


def newer_than(df: DataFrame, ts: str, span: str, now: datetime | Column | None = None) -> DataFrame:
    """Rows of the last span before now, which is the current time unless given."""
    now = F.current_timestamp() if now is None else F.lit(now) if isinstance(now, datetime) else now
    return df.filter(F.col(ts) >= now - F.expr(f"INTERVAL '{int(interval(span).total_seconds())}' SECOND"))


def known_area(df: DataFrame, area: str = "dk_area") -> DataFrame:
    return df.filter(F.col(area).isNotNull() & (F.col(area) != "UNKNOWN"))


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


#: Types that can hold NaN, and those that can be 0.
FLOATS = ("double", "float")
NUMBERS = (*FLOATS, "tinyint", "smallint", "int", "bigint")


def missing(c: Column | str, kind: str = "double") -> Column:
    """Null, or NaN where the column's type (as in DataFrame.dtypes) has it."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull() | F.isnan(c) if kind in FLOATS else c.isNull()


def ensure_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Adds the columns that df lacks, as nulls of their type."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in df.columns})


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The columns of types, in their order and of their types; missing ones are null, others go."""
    return ensure_columns(df, types).select(*[F.col(c).cast(t).alias(c) for c, t in types.items()])


def any_of(conditions: list[Column]) -> Column:
    """Whether one of the conditions holds, as a flat tree, however many there are."""
    if not conditions:
        return F.lit(False)
    half = len(conditions) // 2
    return conditions[0] if not half else any_of(conditions[:half]) | any_of(conditions[half:])


def partitions_of(store: DataFrame, batch: DataFrame, keys: list[str], most: int = 1000) -> DataFrame:
    """The partitions of store that batch has rows for.

    Up to most of them are named in the filter, so that Spark lists and reads no others; beyond, the store is joined with them.
    """
    wanted = batch.select(*keys).distinct()
    rows = wanted.limit(most + 1).collect()
    if len(rows) > most:
        return store.join(wanted, keys, "left_semi")
    last: dict[tuple, list] = {}  # values of the last key by those of the others
    for r in rows:
        last.setdefault(tuple(r)[:-1], []).append(r[-1])
    named = []
    for first, values in last.items():
        known = [v for v in values if v is not None]
        c = F.col(keys[-1]).isin(*known) if known else F.lit(False)
        c = c | F.col(keys[-1]).isNull() if None in values else c
        named.append(reduce(and_, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(keys, first)], c))
    return store.filter(any_of(named))


def check_range(start: datetime | None, end: datetime | None) -> None:
    if start is None or end is None:
        raise ValueError("start and end are required")
    if not start < end:
        raise ValueError("start must be before end")
