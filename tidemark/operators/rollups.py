"""Roll-ups that add up: moments of a series in buckets, answers over any range from them, and their refresh from what has changed.

A row of a roll-up has bucket, type, rows (all), count (of values that are not null), sum, m2 (the squared differences to the mean, summed), min and max.
Such rows can be merged, so coarser buckets, whole ranges and deviations come from them without a look at raw rows.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bucket_width, named_range, time_bucket
from .filters import any_of, check_range, interval
from .maintenance import exists, remove, replace_partitions, swap
from .series import ROLLUPS, of_series

#: How long a bucket stays open after its end, before it is made (fixed values).
OPEN_FOR = {"5 minutes": "5 minutes", "1 hour": "1 hour", "1 day": "1 day"}
MOMENTS = ("rows", "count", "sum", "m2", "min", "max")
_ZERO = datetime(1970, 1, 1)


def _moments(df: DataFrame, keys: list, value: str = "value") -> DataFrame:
    n = F.count(value)
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"), n.alias("count"), F.sum(value).alias("sum"), F.coalesce(F.var_pop(value) * n, F.lit(0.0)).alias("m2"), F.min(value).alias("min"), F.max(value).alias("max")
    )


def moments(meas: DataFrame, width: str) -> DataFrame:
    """The roll-up of meas(time, value, type) in buckets of a width."""
    return _moments(meas, [time_bucket("time", width).alias("bucket"), "type"])


def merged(rows: DataFrame, keys: list[str], spread: bool = True) -> DataFrame:
    """Moments of the groups of rows, which are moments themselves.

    The mean comes first, then the differences to it, so nothing is lost where means are large and deviations small; without spread m2 is left out and once is enough.
    """
    sums = {"rows": F.sum("rows"), "count": F.sum("count"), "sum": F.sum("sum"), "min": F.min("min"), "max": F.max("max")}
    whole = rows.groupBy(*keys).agg(*[c.alias(k) for k, c in sums.items()])
    if not spread:
        return whole
    means = whole.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.col("sum") / F.col("count")).alias("_mean"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    apart = rows.join(means, same) if keys else rows.crossJoin(F.broadcast(means))  # without keys means is one row
    off = F.col("m2") + F.when(F.col("count") > 0, F.col("count") * F.pow(F.col("sum") / F.col("count") - F.col("_mean"), 2)).otherwise(0.0)
    m2 = apart.groupBy(*keys).agg(F.sum(off).alias("m2"))
    if not keys:
        return whole.crossJoin(F.broadcast(m2)).select(*MOMENTS)
    m2 = m2.select(*[F.col(k).alias(f"_{k}") for k in keys], "m2")
    return whole.join(m2, same).select(*keys, *MOMENTS)


def coarser_moments(rolled: DataFrame, width: str) -> DataFrame:
    return merged(rolled.withColumn("bucket", time_bucket("bucket", width)), ["bucket", "type"])


def usable(width: str | None, stored: tuple[str, ...]) -> list[str]:
    """The stored widths whose buckets lie within those of a width, the coarsest first. Months and years are made of days and what divides them; any stored width will do for no width."""
    if width is None:
        fits = list(stored)
    else:
        whole = interval("1 day" if width.split()[1].rstrip("s") in ("month", "year") else width)
        fits = [w for w in stored if whole % interval(w) == timedelta(0)]
    return sorted(fits, key=interval, reverse=True)


def cover(start: datetime, end: datetime, widths: list[str]) -> list[tuple[str, datetime, datetime]]:
    """[start, end) cut into the coarsest aligned middle, finer aligned sides, and edges of raw rows: (width or 'raw', from, to), in order.

    widths go from the coarsest to the finest.
    """
    if start >= end:
        return []
    if not widths:
        return [("raw", start, end)]
    w = interval(widths[0])
    first, last = start + (_ZERO - start) % w, end - (end - _ZERO) % w
    if first >= last:
        return cover(start, end, widths[1:])
    return [*cover(start, first, widths[1:]), (widths[0], first, last), *cover(last, end, widths[1:])]


def within(df: DataFrame, ts: str, ranges: list[tuple[datetime, datetime]]) -> DataFrame:
    """The rows in one of the half-open ranges; a store that has its rows by day is read in the days of these only."""

    def one(lo: datetime, hi: datetime) -> Column:
        c = (F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi))
        return c & F.col("day").between(F.lit(lo.date()), F.lit((hi - timedelta(microseconds=1)).date())) if dict(df.dtypes).get("day") == "date" else c

    return df.filter(any_of([one(*r) for r in ranges]))


def parts(rollups: dict[str, DataFrame], meas: DataFrame, start: datetime, end: datetime, series: str | None, width: str | None) -> DataFrame:
    """Partial moments of [start, end) by timestamp (the bucket of a width, or null without one) and type. Each source is read once, in its ranges."""
    legs: dict[str, list] = {}
    for source, lo, hi in cover(start, end, usable(width, tuple(rollups))):
        legs.setdefault(source, []).append((lo, hi))
    at = lambda c: time_bucket(c, width) if width else F.lit(None).cast("timestamp")
    out = []
    for source, ranges in legs.items():
        if source == "raw":
            rows = of_series(within(meas, "time", ranges), series)
            out.append(_moments(rows, [at("time").alias("timestamp"), "type"]))
        else:
            rows = of_series(within(rollups[source], "bucket", ranges), series)
            out.append(rows.select(at("bucket").alias("timestamp"), "type", *MOMENTS))
    return reduce(DataFrame.unionByName, out)


def from_rollups(rollups: dict[str, DataFrame], meas: DataFrame, start: datetime | None = None, end: datetime | None = None, series: str | None = None, width: str | None = None, range: str | None = None, now: datetime | None = None) -> DataFrame:
    """What series.historical answers, for any range: from roll-ups (moments by width) but for the edges, for which raw rows are read.

    Roll-ups must hold all buckets of the range that they are asked for; RollupStore says up to when they do.
    """
    if range:
        start, end = named_range(range, now)
    check_range(start, end)
    width = width or bucket_width(start, end)
    out = merged(parts(rollups, meas, start, end, series, width), ["timestamp", "type"], spread=False)
    return out.select("timestamp", "type", (F.col("sum") / F.col("count")).alias("value"), "min", "max", F.col("rows").alias("count")).orderBy("timestamp", "type")


def stats_from_rollups(rollups: dict[str, DataFrame], meas: DataFrame, start: datetime, end: datetime, series: str | None = None) -> DataFrame:
    """What series.stats answers, deviations included, from roll-ups but for the edges of the range."""
    check_range(start, end)
    out = merged(parts(rollups, meas, start, end, series, None).drop("timestamp"), ["type"])
    deviation = F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1)))
    return out.select("type", (F.col("sum") / F.col("count")).alias("avg"), "min", "max", deviation.alias("stddev"), F.col("rows").alias("count"))


def spans(days: list[date]) -> list[tuple[datetime, datetime]]:
    """Sorted days as half-open ranges, those that follow each other as one."""
    out: list[tuple[datetime, datetime]] = []
    for d in days:
        lo = datetime.combine(d, time.min)
        if out and out[-1][1] == lo:
            out[-1] = (out[-1][0], lo + timedelta(days=1))
        else:
            out.append((lo, lo + timedelta(days=1)))
    return out


class RollupStore:
    """Roll-ups stored by day, and the set of their dirty buckets.

    Whoever writes measurements notes the batch. A refresh makes the dirty buckets anew that have been closed for long enough: the finest from raw
    rows, each coarser one from the finer, whose buckets it inherits as dirty. Only the days of those buckets are rewritten. Late and repeated rows just make
    their buckets dirty again. Buckets are marked clean last, so a refresh that dies is done again. One refresh runs at a time.
    """

    def __init__(self, spark: SparkSession, root: str, widths: tuple[str, ...] = ROLLUPS, open_for: dict[str, str] = OPEN_FOR):
        self.spark, self.root, self.open_for = spark, root.rstrip("/"), open_for
        self.widths = tuple(sorted(widths, key=interval))
        if any(interval(b) % interval(a) for a, b in zip(self.widths, self.widths[1:])):
            raise ValueError("each width must be made of the one before")

    def path(self, width: str) -> str:
        return f"{self.root}/{width.replace(' ', '_')}"

    def _dirty(self, width: str) -> str:
        return f"{self.root}/dirty/{width.replace(' ', '_')}"

    def read(self, width: str) -> DataFrame:
        return self.spark.read.parquet(self.path(width))

    def rollups(self) -> dict[str, DataFrame]:
        """The roll-ups that are there, as from_rollups takes them."""
        return {w: self.read(w) for w in self.widths if exists(self.spark, self.path(w))}

    def _note(self, width: str, buckets: DataFrame) -> None:
        buckets.select("bucket", "type").distinct().write.mode("append").parquet(self._dirty(width))

    def note(self, batch: DataFrame) -> None:
        """Marks the buckets of a batch of measurements as dirty; after the batch has been stored, or before."""
        self._note(self.widths[0], batch.select(time_bucket("time", self.widths[0]).alias("bucket"), "type"))

    def foreach_note(self, write):
        """A foreachBatch sink that writes a batch by write(batch, id) and notes it."""

        def sink(batch: DataFrame, i: int) -> None:
            batch.persist()
            try:
                self.note(batch)
                write(batch, i)
            finally:
                batch.unpersist()

        return sink

    def pending(self, width: str) -> DataFrame | None:
        return self.spark.read.parquet(self._dirty(width)).distinct() if exists(self.spark, self._dirty(width)) else None

    def refresh(self, meas: DataFrame, now: datetime) -> dict[str, int]:
        """Makes the dirty buckets that are closed at now anew, from meas(time, value, type); how many of each width."""
        done = {}
        for k, width in enumerate(self.widths):
            done[width] = 0
            dirty = self.pending(width)
            if dirty is None:
                continue
            closed = F.col("bucket") <= F.lit(now - interval(width) - interval(self.open_for.get(width, "0 seconds")))
            ready = dirty.filter(closed)
            counts = dict(ready.groupBy(F.to_date("bucket")).count().collect())  # a row for each day
            days = sorted(counts)
            if not days:
                continue
            done[width], span = sum(counts.values()), spans(days)
            source = within(meas, "time", span) if k == 0 else within(self.read(self.widths[k - 1]), "bucket", span)
            rows = source.withColumn("_b", time_bucket("time" if k == 0 else "bucket", width))
            mark = ready.select(F.col("bucket").alias("_m"), F.col("type").alias("_t"))
            rows = rows.join(mark, F.col("_b").eqNullSafe(F.col("_m")) & F.col("type").eqNullSafe(F.col("_t")), "left_semi")
            new = moments(rows, width) if k == 0 else coarser_moments(rows.drop("day"), width)
            if exists(self.spark, self.path(width)):
                old = within(self.read(width), "bucket", span)
                same = F.col("bucket").eqNullSafe(F.col("_m")) & F.col("type").eqNullSafe(F.col("_t"))
                new = new.unionByName(old.join(mark, same, "left_anti").select(*new.columns))
            replace_partitions(self.spark, new.withColumn("day", F.to_date("bucket")), self.path(width), ["day"], [(d,) for d in days])
            if k + 1 < len(self.widths):
                self._note(self.widths[k + 1], ready.select(time_bucket("bucket", self.widths[k + 1]).alias("bucket"), "type"))
            left = f"{self._dirty(width)}.left"
            remove(self.spark, left)
            dirty.filter(~closed).write.parquet(left)
            swap(self.spark, self._dirty(width), left)
        return done


def source_bits(obs: DataFrame, source: str, keys: list[str], width: str, ts: str = "ts") -> DataFrame:
    """Which sources are seen in each bucket: bucket, keys, part, bits. source is a number of 0 or more; a part has 32768 of them, bits is its bitmap.

    Bitmaps of the same part can be merged, so distinct sources of any span of buckets are exact.
    """
    n = F.col(source).cast("long") + 1  # positions of bitmaps start with 1
    rows = obs.filter(F.col(source).isNotNull()).select(time_bucket(ts, width).alias("bucket"), *keys, F.bitmap_bucket_number(n).alias("part"), F.bitmap_bit_position(n).alias("_bit"))
    return rows.groupBy("bucket", *keys, "part").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def coarser_bits(bits: DataFrame, keys: list[str], width: str) -> DataFrame:
    return bits.groupBy(time_bucket("bucket", width).alias("bucket"), *keys, "part").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_sources(bits: DataFrame, keys: list[str], start: datetime | None = None, end: datetime | None = None, name: str = "n_sources") -> DataFrame:
    """Distinct sources for each of keys over the buckets of [start, end), or all; a bitmap for each part comes from each task, never a list of sources."""
    if start is not None:
        check_range(start, end)
        bits = within(bits, "bucket", [(start, end)])
    merged_bits = bits.groupBy(*keys, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged_bits.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
