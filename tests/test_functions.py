from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import functions as f


def row(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def ts(text):
    return F.to_timestamp(F.lit(text))


def test_times(spark):
    at = ts("2024-02-03 10:09:59.999")
    r = row(
        spark,
        iso=f.parse_iso(F.lit("2024-02-03T10:00:00Z")),
        bad=f.parse_iso(F.lit("noon")),
        bucket=f.bucket10(at),
        edge=f.bucket10(ts("2024-02-03 10:10:00")),
        nanos=f.from_nanos(F.lit(1706954400123456789)),
        day=f.weekday(ts("2024-02-04")),
        weekend=f.is_weekend(ts("2024-02-03")),
        monday=f.is_weekend(ts("2024-02-05")),
        text=f.bucket_text(at),
        five=f.time_bucket(at, "5 minutes"),
        month=f.time_bucket(at, "1 month"),
    )
    assert r.iso == datetime(2024, 2, 3, 10) and r.bad is None
    assert (r.bucket, r.edge, r.day, r.weekend, r.monday) == (0, 10, 0, 1, 0)
    assert r.nanos == datetime(2024, 2, 3, 10, 0, 0, 123456)
    assert r.text == "2024-02-03 10:09:59" and r.five == datetime(2024, 2, 3, 10, 5) and r.month == datetime(2024, 2, 1)


def test_cycle(spark):
    sin, cos = f.cyclic(F.lit(6), 24)
    r = row(spark, s=sin, c=cos)
    assert r.s == pytest.approx(1) and r.c == pytest.approx(0)


def test_values(spark):
    nan, inf = F.lit(float("nan")), F.lit(float("-inf"))
    r = row(
        spark,
        nan=f.finite(nan),
        inf=f.finite(inf),
        fine=f.finite(F.lit(2.5)),
        bad=f.to_number(F.lit("x")),
        first=f.first_truthy(F.lit(None).cast("string"), F.lit(0), F.lit(""), F.lit("7"), F.lit("8")),
        none=f.first_truthy(F.lit(0), F.lit("")),
        pct=f.variance_pct(F.lit(110.0), F.lit(80.0)),
        zero=f.variance_pct(F.lit(110.0), F.lit(0.0)),
        key=f.message_key(F.lit("a"), F.lit(None).cast("string"), F.lit(3)),
        area=f.area_of(F.lit("SE4")),
        known=f.area_of(F.lit("DK2")),
        nested=f.field(F.lit('{"a": {"b": 4}}'), "a.b"),
    )
    assert (r.nan, r.inf, r.fine, r.bad, r.first, r.none) == (None, None, 2.5, None, "7", None)
    assert (r.pct, r.zero, r.key, r.area, r.known, r.nested) == (37.5, None, "a_3", "UNKNOWN", "DK2", "4")


def test_ranges():
    now = datetime(2024, 3, 1)
    widths = [f.bucket_width(*f.named_range(r, now)) for r in ("1h", "1d", "1w", "1m")]
    assert widths == ["1 minute", "5 minutes", "1 hour", "1 day"]
    with pytest.raises(ValueError):
        f.named_range("2y", now)
