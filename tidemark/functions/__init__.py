"""Column functions for times and loosely typed values."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_iso(c: Column | str, pattern: str | None = None) -> Column:
    """ISO-8601 text to a timestamp, null where it is none."""
    return F.try_to_timestamp(col(c), F.lit(pattern)) if pattern else F.try_to_timestamp(col(c))


def date_parts(df: DataFrame, ts: str, minutes: bool = False) -> DataFrame:
    """Adds year, month, day and hour of ts; with minutes, also its 10-minute bucket."""
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts), "hour": F.hour(ts)}
    return df.withColumns(parts | ({"minute_bucket": bucket10(ts)} if minutes else {}))


def bucket10(ts: Column | str) -> Column:
    """The minute at which a timestamp's 10-minute bucket begins."""
    return (F.floor(F.minute(col(ts)) / 10) * 10).cast("int")


def from_nanos(c: Column | str) -> Column:
    """Nanoseconds since 1970 to a timestamp, in whole microseconds, without a detour over doubles."""
    nanos = col(c).cast("long")
    return F.timestamp_micros(F.floor(nanos.cast("decimal(20,0)") / 1000).cast("long"))


def cyclic(c: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value on a circle."""
    angle = col(c) * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def weekday(ts: Column | str) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(col(ts)) - 1


def is_weekend(ts: Column | str) -> Column:
    return F.when(weekday(ts).isin(0, 6), 1).otherwise(0)


def date_of(year: Column | str, month: Column | str, day: Column | str) -> Column:
    return F.make_date(col(year), col(month), col(day))


def hour_of(year: str = "year", month: str = "month", day: str = "day", hour: str = "hour") -> Column:
    """The timestamp of an hour from its parts."""
    return F.make_timestamp_ntz(F.col(year), F.col(month), F.col(day), F.col(hour), F.lit(0), F.lit(0))


def hour_epoch(year: str = "year", month: str = "month", day: str = "day", hour: str = "hour") -> Column:
    return F.unix_timestamp(hour_of(year, month, day, hour).cast("timestamp"))


def bucket_text(ts: Column | str, iso: bool = False) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'" if iso else "yyyy-MM-dd HH:mm:ss")


def iso_text(ts: Column | str) -> Column:
    return bucket_text(ts, iso=True)


def area_of(price_area: Column | str, areas: tuple[str, ...] = ("DK1", "DK2")) -> Column:
    """A price area's name, UNKNOWN for other ones and null."""
    return F.when(col(price_area).isin(*areas), col(price_area)).otherwise("UNKNOWN")


def time_bucket(ts: Column | str, width: str, start: str | None = None) -> Column:
    """The beginning of the bucket of a width such as '5 minutes'; months and years go by the calendar."""
    unit = width.split()[-1].rstrip("s")
    if unit in ("month", "year") and width.split()[0] == "1":
        return F.date_trunc(unit, col(ts))
    return F.window(col(ts), width, startTime=start)["start"]


def bucket_width(start: datetime, end: datetime) -> str:
    """The width that suits a range: a minute up to 1 hour, 5 minutes up to a day, an hour up to a week, else a day."""
    hours = (end - start) / timedelta(hours=1)
    return next((w for most, w in ((1, "1 minute"), (24, "5 minutes"), (168, "1 hour")) if hours <= most), "1 day")


RANGES = {"1h": 1, "6h": 6, "12h": 12, "1d": 24, "3d": 72, "1w": 168, "1m": 720}


def named_range(name: str, now: datetime) -> tuple[datetime, datetime]:
    """The range that ends now; a month has 30 days."""
    if name not in RANGES:
        raise ValueError(f"range must be one of {tuple(RANGES)}")
    return now - timedelta(hours=RANGES[name]), now


def first_truthy(*cols: Column | str) -> Column:
    """The first value that is neither null nor 0 nor an empty text, as text."""
    texts = [col(c).cast("string") for c in cols]
    return F.coalesce(*[F.when(~t.isin("", "0", "0.0"), t) for t in texts])


def to_number(c: Column | str) -> Column:
    """A double, or null for what is no number."""
    return col(c).try_cast("double")


def finite(c: Column | str) -> Column:
    """Null for NaN and the infinities."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def variance_pct(predicted: Column | str, actual: Column | str) -> Column:
    """How far predicted is off actual in percent, to a decimal; null if either is 0 or missing."""
    p, a = F.nullif(col(predicted), F.lit(0.0)), F.nullif(col(actual), F.lit(0.0))
    return F.round((p - a) / a * 100, 1)


def message_key(*cols: Column | str) -> Column:
    """The parts that are not null, joined by underscores."""
    return F.concat_ws("_", *[col(c).cast("string") for c in cols])


def circular_mean(c: Column | str) -> tuple[Column, Column]:
    """Aggregates: mean sine and mean cosine of a direction in degrees."""
    return F.avg(F.sin(F.radians(col(c)))), F.avg(F.cos(F.radians(col(c))))


def prediction_json(consumption: Column | str, production: Column | str | None = None) -> Column:
    """The nested part of a prediction message; what isn't predicted is 0."""
    made = col(production) if production is not None else F.lit(0.0)
    return F.struct(col(consumption).alias("consumption_mwh"), made.alias("production_mwh"), F.lit(0.0).alias("net_balance_mwh"))


def field(text: Column | str, path: str) -> Column:
    """A field of a JSON text by its path, such as 'predictions.consumption_mwh'."""
    return F.get_json_object(col(text), f"$.{path}")
