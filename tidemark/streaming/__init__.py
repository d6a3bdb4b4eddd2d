"""Streams: windowed area means, landing of topics, live series."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions import circular_mean, first_truthy, parse_iso, to_number
from ..operators.filters import newer_than
from ..operators.joins import BUCKET_KEYS, small
from ..operators.series import latest_points, newest
from ..operators.sinks import DAY, append_new


def bucket_stream(obs: DataFrame, params: tuple[str, ...], width: str = "10 minutes", delay: str = "20 minutes", ts: str = "ts") -> DataFrame:
    """Each station's means in tumbling windows; a window closes when its end is delay behind the newest observation.

    obs(station_id, parameter_id, ts, value). Pivots don't run on streams, so each parameter is a conditional mean.
    Observations for a closed window are dropped.
    """
    means = [F.avg(F.when(F.col("parameter_id") == p, F.col("value"))).alias(p) for p in params]
    rows = obs.filter(F.col("parameter_id").isin(*params)).withWatermark(ts, delay)
    return rows.groupBy("station_id", F.window(ts, width)).agg(*means)


def area_stream(obs: DataFrame, dim: DataFrame, params: tuple[str, ...], width: str = "10 minutes", delay: str = "20 minutes", maxima: tuple[str, ...] = ("wind_max",), counted: str | None = "temp_dry", direction: str | None = None) -> DataFrame:
    """Means over the station means for each area and window: dk_area, bucket, the parameters, n_stations.

    dim(station_id, dk_area) is a static table, the stations known; it is broadcast if it is small.
    """
    wide = bucket_stream(obs, params, width, delay).join(small(dim), "station_id")
    aggs: list[Column] = []
    for p in params:
        if p == direction:
            sin, cos = circular_mean(p)
            aggs += [sin.alias(f"{p}_sin"), cos.alias(f"{p}_cos")]
        else:
            aggs.append((F.max(p) if p in maxima else F.avg(p)).alias(p))
    stations = (F.count(counted) if counted else F.lit(0)).cast("int").alias("n_stations")
    out = wide.groupBy("dk_area", F.window(F.window_time("window"), width).alias("window")).agg(*aggs, stations)
    return out.select("dk_area", F.col("window.start").alias("bucket"), *[c for c in out.columns if c not in ("dk_area", "window")])


def start(writer: DataStreamWriter, checkpoint: str, every: str = "60 seconds", once: bool = False, name: str | None = None) -> StreamingQuery:
    """Starts a query that runs at most so often, or takes what is there and ends."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def write_new(path: str, keys: list[str] | None = None, partitions: list[str] | None = None, fresh: str | None = None, ts: str = "bucket", now: datetime | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink that appends the rows whose key isn't stored, so a batch that runs twice adds nothing.

    Of the store only the batch's partitions are read: those given, else year, month and day where they are part of the key. Only a key without
    them is looked up in the whole store. fresh leaves out rows older than that span.
    """
    keys = keys or BUCKET_KEYS
    if partitions is None:
        partitions = DAY if set(DAY) <= set(keys) else []
    if not set(partitions) <= set(keys):
        raise ValueError("partitions must be part of the key")

    def write(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            append_new(newer_than(batch, ts, fresh, now) if fresh else batch, path, keys, partitions)
        finally:
            batch.unpersist()

    return write


def _by_date(stream: DataFrame, ts: str, parts: tuple[str, ...]) -> DataFrame:
    units = {"year": F.year, "month": F.month, "day": F.day}
    return stream.withColumns({p: units[p](ts) for p in parts})


def land_observations(stream: DataFrame, path: str, checkpoint: str, ts: str = "ts", every: str = "5 minutes", rows: int = 10_000, once: bool = False) -> StreamingQuery:
    """Observations to Parquet by day of the event, in files of so many rows at most."""
    df = _by_date(stream, ts, ("year", "month", "day"))
    writer = df.writeStream.format("parquet").partitionBy("year", "month", "day").option("path", path).option("maxRecordsPerFile", rows)
    return start(writer, checkpoint, every, once)


def land_energy(stream: DataFrame, path: str, checkpoint: str, ts: str = "ts", every: str = "1 hour", once: bool = False) -> StreamingQuery:
    df = _by_date(stream, ts, ("year", "month"))
    return start(df.writeStream.format("parquet").partitionBy("year", "month").option("path", path), checkpoint, every, once)


def land_predictions(stream: DataFrame, path: str, checkpoint: str, every: str = "60 seconds", once: bool = False) -> StreamingQuery:
    return start(stream.writeStream.format("json").option("path", path), checkpoint, every, once)


#: Everything is read as text: senders differ in what they quote.
MESSAGE = (
    "timestamp string, HourUTC string, HourDK string, dk_area string, PriceArea string, value string, total_consumption_mwh string, ShareMWh string, "
    "total_production_mwh string, predictions struct<consumption_mwh string, production_mwh string, net_balance_mwh string>"
)


def message_points(messages: DataFrame, series: str, value: str = "value") -> DataFrame:
    """(timestamp, value, production, net_balance, dk_area, type) of JSON messages; the first name of a field that says something counts."""
    messages = messages.withColumn("_m", F.from_json(F.col(value).cast("string"), MESSAGE))
    f = lambda *paths: first_truthy(*[F.col(f"_m.{p}") for p in paths])
    number = lambda *paths: F.coalesce(to_number(f(*paths)), F.lit(0.0))
    if series == "actual":
        amount, made, net = number("total_consumption_mwh", "value", "ShareMWh"), number("total_production_mwh"), F.lit(0.0)
    else:
        amount, made, net = number("predictions.consumption_mwh", "value"), number("predictions.production_mwh"), number("predictions.net_balance_mwh")
    ts = parse_iso(f("timestamp", "HourUTC", "HourDK"))
    out = messages.select(ts.alias("timestamp"), amount.alias("value"), made.alias("production"), net.alias("net_balance"), f("dk_area", "PriceArea").alias("dk_area"), F.lit(series).alias("type"))
    return out.dropna(subset=["timestamp"])


def live_series(points: DataFrame, dedup_keys: list[str] | None = None, keep: str = "24 hours", now: datetime | None = None) -> DataFrame:
    """Running sums for each time and series, for update mode; points older than keep are dropped.

    dedup_keys drops messages that come again within that span. The area of a time is the least one, as the order of
    arrival isn't defined.
    """
    df = newer_than(points, "timestamp", keep, now).withWatermark("timestamp", keep)
    if dedup_keys:
        df = df.dropDuplicatesWithinWatermark(dedup_keys)
    sums = [F.sum(c).alias(c) for c in ("value", "production", "net_balance")]
    return df.groupBy("timestamp", "type").agg(*sums, F.min("dk_area").alias("dk_area"))


def newest_points(batch: DataFrame, n: int = 100) -> DataFrame:
    """The newest n times of each series of a batch of live sums; for use inside foreachBatch."""
    return newest(batch, ["type"], n, "timestamp")


def hydrate(meas: DataFrame, n: int = 100, within: str = "48 hours", now: datetime | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """The newest n points of either series that lie within a span; ties break by the columns given, or all others."""
    return latest_points(meas, "actual", n, now, within, ties).unionByName(latest_points(meas, "predicted", n, now, within, ties))


def dedup_stream(obs: DataFrame, delay: str = "20 minutes", ts: str = "ts") -> DataFrame:
    """Drops observations that were sent again within the delay."""
    return obs.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["station_id", "parameter_id", ts])
