"""Writing tables, messages and upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import finite, iso_text, message_key
from .filters import partitions_of
from .joins import BUCKET_KEYS, new_only
from .maintenance import _read_text, _write_text, exists, replace_partitions

DAY = ["year", "month", "day"]


def write_daily(df: DataFrame, path: str, rows: int | None = None) -> None:
    """Appends by day. Rows of a day meet in a task before they are written, so a day is a file; a day larger than
    spark.sql.adaptive.advisoryPartitionSizeInBytes is split over several tasks, a file each, and small days share a task. rows bounds the rows of a file.
    """
    writer = df.hint("rebalance", *DAY).write.mode("append").partitionBy(*DAY)
    (writer.option("maxRecordsPerFile", rows) if rows else writer).parquet(path)


def append_table(df: DataFrame, path: str, keys: list[str]) -> None:
    df.write.mode("append").partitionBy(*keys).parquet(path)


def overwrite_table(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces the partitions that df has rows for and leaves the others. df must not read from path."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str], partitions: list[str]) -> None:
    """Appends the rows whose key isn't stored yet, one for each key. Of the store only df's partitions are read; partitions must be part of the key."""
    spark = df.sparkSession
    df = df.dropDuplicates(keys)
    if not exists(spark, path):
        append_table(df, path, partitions)
        return
    df.persist()  # for its partitions and its rows
    try:
        stored = spark.read.parquet(path)
        append_table(new_only(df, partitions_of(stored, df, partitions) if partitions else stored, keys), path, partitions)
    finally:
        df.unpersist()


def log_predictions(df: DataFrame, path: str) -> None:
    """Notes the buckets that df predicts, by day."""
    append_table(df.select(*BUCKET_KEYS, F.current_timestamp().alias("predicted_at")), path, DAY)


def to_messages(df: DataFrame, key_cols: list[str], value_cols: list[str] | None = None) -> DataFrame:
    """(key, value): the key's parts joined by underscores, the value as JSON, fields that are null included."""
    value = F.to_json(F.struct(*(value_cols or df.columns)), {"ignoreNullFields": "false"})
    return df.select(message_key(*key_cols).alias("key"), value.alias("value"))


def publish(messages: DataFrame, topic: str, servers: str) -> None:
    """Writes messages to a topic (needs Spark's Kafka package on the cluster)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def replay(df: DataFrame, columns: list[str], mapping: dict[str, str] | None = None) -> DataFrame:
    """Stored rows as messages: renamed, missing columns null, NaN and infinities null, times as ISO text, keyed by the first two columns."""
    df = df.withColumnsRenamed(mapping or {})
    types = dict(df.dtypes)
    out = []
    for c in columns:
        kind = types.get(c)
        v = F.lit(None).cast("string") if kind is None else F.col(c)
        v = finite(v) if kind in ("double", "float") else iso_text(v) if kind in ("timestamp", "timestamp_ntz", "date") else v
        out.append(v.alias(c))
    return to_messages(df.select(*out), columns[:2])


SLOTS = 4


def upsert_measurements(batch: DataFrame, path: str, order: tuple[str, ...] = (), slots: int = SLOTS, ordered: bool = False) -> None:
    """Merges a batch into stored measurements, one row for each (time, type): the batch's wins, within it the last by order (else by all other columns).
    With ordered a stored row that is later by order than the batch's stays, so an old row that comes again changes nothing; of equals the batch's wins.

    Stored by day and by slot, a hash of (time, type); only the slots that the batch has rows for are read and rewritten, so ten rows rewrite ten at most. A store keeps
    the number of slots that it began with; one that is by day alone stays so.
    """
    spark, keys = batch.sparkSession, ["time", "type"]
    there, layout = exists(spark, path), ["day", "slot"]
    if there:
        stored = spark.read.parquet(path)
        layout = [k for k in layout if k in stored.columns]
        slots = int(_read_text(spark, f"{path}/_slots")) if "slot" in layout else 0
    rest = [c for c in batch.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*(order or rest))) if rest else None
    fresh = batch.groupBy(*keys).agg(last.alias("_row")).select(*keys, "_row.*") if rest else batch.select(*keys).distinct()
    fresh = fresh.select(*batch.columns, F.to_date("time").alias("day"), *([F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int").alias("slot")] if "slot" in layout else []))
    if not there:
        overwrite_table(fresh.hint("rebalance", *layout), path, layout)
        _write_text(spark, f"{path}/_slots", str(slots))
        return
    fresh.persist()  # for its slots and its rows
    try:
        touched = partitions_of(stored, fresh, layout)
        if ordered and rest:
            both = touched.select(*fresh.columns, F.lit(0).alias("_new")).unionByName(fresh.withColumn("_new", F.lit(1)))
            last = F.max_by(F.struct(*rest), F.struct(*(order or rest), "_new"))
            merged = both.groupBy(*keys, *layout).agg(last.alias("_row")).select(*keys, *layout, "_row.*").select(*fresh.columns)
        else:
            merged = new_only(touched, fresh, keys).select(*fresh.columns).unionByName(fresh)
        replace_partitions(spark, merged, path, layout)
    finally:
        fresh.unpersist()


def foreach_upsert(path: str, order: tuple[str, ...] = (), ordered: bool = False) -> Callable[[DataFrame, int], None]:
    """upsert_measurements as a sink of a stream's batches."""
    return lambda batch, _: upsert_measurements(batch, path, order, ordered=ordered)
