"""Streams that remember: live series by arbitrary state, and runs by processing-time timers.

What goes into the state is cut down in the tasks that read it first, so a hot series or topic does not fill one task with its messages.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.filters import interval, newer_than

SUMS = ("value", "production", "net_balance")
PARTIAL = "type string, shard int, timestamp timestamp, value double, production double, net_balance double, n long, first long, dk_area string"
POINT = "type string, shard int, timestamp timestamp, value double, production double, net_balance double, dk_area string, n long"


class LivePoints:
    """The state of a series, or of a shard of it: its newest points by time, each with its sums, the area that came first, the messages that it is made of and when it last changed."""

    def __init__(self, most: int, keep_ms: int):
        self.most, self.keep_ms = most, keep_ms

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = {int(t): p for t, p in json.loads(state.get[0]).items()} if state.exists else {}
        held = {t: p for t, p in held.items() if now - p[5] < self.keep_ms}
        if state.hasTimedOut:
            self._hold(held, state, now)
            return
        df = pd.concat(list(frames)).sort_values("first")
        df["at"] = _micros(df["timestamp"])
        changed = {}
        for t, rows in df.groupby("at", sort=True):
            old = held.get(t)
            sums = [float(rows[c].sum()) + (old[i] if old else 0.0) for i, c in enumerate(SUMS)]
            first = rows["dk_area"].iloc[0]
            area = old[3] if old else None if pd.isna(first) else first
            held[t] = [*sums, area, int(rows["n"].sum()) + (old[4] if old else 0), now]
            changed[t] = rows["timestamp"].iloc[0]
        held = {t: held[t] for t in sorted(held)[-self.most :]}
        self._hold(held, state, now)
        out = [(*key, changed[t], *held[t][:5]) for t in changed if t in held]
        if out:
            yield pd.DataFrame(out, columns=["type", "shard", "timestamp", *SUMS, "dk_area", "n"])

    def _hold(self, held: dict, state: GroupState, now: int) -> None:
        """Keeps what is held; looks again when the oldest of it gets too old."""
        if not held:
            state.remove()
            return
        state.update((json.dumps(held),))
        state.setTimeoutDuration(max(1, min(p[5] for p in held.values()) + self.keep_ms - now))


def _micros(at: pd.Series) -> pd.Series:
    """Microseconds since the epoch."""
    return (at.dt.tz_convert("UTC").dt.tz_localize(None) if at.dt.tz is not None else at).astype("datetime64[us]").astype("int64")


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each point of an Arrow batch: its sums, how many messages, the least order and the area that came with it."""
    for b in batches:
        t = pa.Table.from_batches([b]).sort_by([("first", "ascending")])
        g = t.group_by(["type", "shard", "timestamp"], use_threads=False).aggregate([*[(c, "sum") for c in SUMS], ("n", "sum"), ("first", "min"), ("dk_area", "first", pc.ScalarAggregateOptions(skip_nulls=False))])
        names = {f"{c}_sum": c for c in (*SUMS, "n")} | {"first_min": "first", "dk_area_first": "dk_area"}
        g = g.rename_columns([names.get(c, c) for c in g.column_names]).select([f.name for f in b.schema])
        yield from g.cast(b.schema).to_batches()


def live_points(points: DataFrame, order: str, most: int = 100, keep: str = "24 hours", shards: int = 1, now: datetime | None = None) -> DataFrame:
    """A stream of the points that changed: type, shard, timestamp, sums, dk_area, n, for update mode; of a point the row with the largest n holds.

    points(timestamp, value, production, net_balance, dk_area, type) and a column of the order in which they came, such as an offset. Points older than keep are
    dropped, and forgotten after it. A series of many messages can be cut in shards by time; each keeps its newest, and newest_live picks of all.
    """
    shard = F.pmod(F.xxhash64("timestamp"), F.lit(shards)).cast("int").alias("shard")
    rows = newer_than(points, "timestamp", keep, now).select("type", shard, "timestamp", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in SUMS], F.lit(1).cast("long").alias("n"), F.col(order).cast("long").alias("first"), "dk_area")
    partial = rows.mapInArrow(_partial, PARTIAL)
    processor = LivePoints(most, int(interval(keep).total_seconds() * 1000))
    return partial.groupBy("type", "shard").applyInPandasWithState(processor, POINT, "points string", "update", GroupStateTimeout.ProcessingTimeTimeout)


def newest_live(changes: DataFrame, most: int = 100) -> DataFrame:
    """The newest points of each series from the rows that live_points gave so far."""
    last = changes.groupBy("type", "timestamp").agg(F.max_by(F.struct(*SUMS, "dk_area", "n"), "n").alias("p")).select("type", "timestamp", "p.*")
    w = Window.partitionBy("type").orderBy(F.col("timestamp").desc())
    return last.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= most).drop("_rank")


RUN = "topic string, reason string, at timestamp, run long"


class RunTimer:
    """When to run for a topic: at an event if the last run is long enough ago, and after so long without a run."""

    def __init__(self, gap_ms: int, idle_ms: int):
        self.gap_ms, self.idle_ms = gap_ms, idle_ms

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        last, n = state.get if state.exists else (None, 0)
        for _ in frames:
            pass
        reason = "idle" if state.hasTimedOut else "event"
        if last is None or now - last >= (self.idle_ms if state.hasTimedOut else self.gap_ms):
            last, n = now, n + 1
            yield pd.DataFrame({"topic": [key[0]], "reason": [reason], "at": [datetime.fromtimestamp(now / 1000, timezone.utc)], "run": [n]})
        state.update((last, n))
        state.setTimeoutDuration(max(1, last + self.idle_ms - now))


def _topics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pc.unique(b.column(0))], ["topic"])


def runs(events: DataFrame, topic: str = "topic", gap: str = "60 seconds", idle: str = "600 seconds") -> DataFrame:
    """A stream of runs (topic, reason, at, run): one at an event, but none within gap of the last run, and one after each idle time without a run.

    An event within gap starts none later either. A topic's idle time starts with its first event. Rows with a null topic are ignored. Each task hands on a
    topic once for each of its Arrow batches, however many events there are.
    """
    seen = events.filter(F.col(topic).isNotNull()).select(F.col(topic).cast("string").alias("topic")).mapInArrow(_topics, "topic string")
    timer = RunTimer(*(int(interval(x).total_seconds() * 1000) for x in (gap, idle)))
    return seen.groupBy("topic").applyInPandasWithState(timer, RUN, "last long, run long", "update", GroupStateTimeout.ProcessingTimeTimeout)


def take_all(writer: DataStreamWriter, every: str = "200 milliseconds") -> None:
    """Runs a stream until a batch finds nothing new, then stops it.

    A stream with timeouts never ends by availableNow, as there is always a batch to look for them.
    """
    query = writer.trigger(processingTime=every).start()
    try:
        while query.isActive and not (query.lastProgress and query.lastProgress["numInputRows"] == 0):
            query.awaitTermination(1)
        if query.exception():
            raise query.exception()
    finally:
        query.stop()


def start_runs(runs_: DataFrame, action: Callable[[str, str], None], checkpoint: str, every: str = "1 second") -> StreamingQuery:
    """Calls action(topic, reason) for each run, on the driver; a run that dies is called again."""

    def call(batch: DataFrame, _: int) -> None:
        for r in batch.orderBy("at").collect():  # a row for each topic at most
            action(r["topic"], r["reason"])

    return runs_.writeStream.foreachBatch(call).outputMode("update").option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
