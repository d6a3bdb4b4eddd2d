"""What the text operators share: reading tables, tables in the shared folder, Arrow batches, names of columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch

#: Rows that are looked at together, and bytes of a batch that goes to a Python worker (a larger row goes alone).
BATCH_ROWS, BATCH_MB = 512, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables in the shared folder. A table that is written and read again has no lineage, so a lost executor costs nothing."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df and reads it back."""
        path = scratch(self.spark, name)
        df.write.parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, keep: Iterable[str] = ()) -> None:
        """Deletes the tables that are not named; nothing that is still to run may read them."""
        jvm = getattr(self.spark, "_jvm", None)
        if jvm is None:  # a remote session has no way to the files
            return
        for name in [n for n in self.paths if n not in keep]:
            for path in self.paths.pop(name):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def materialise(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes df into the shared folder and reads it back; the table stays there."""
    return Scratch(df.sparkSession).keep(df, name)


def apart(kept: Iterable[str], results: Iterable[str]) -> list[str]:
    """New names for the kept columns: one that has the name of a result gets underscores until it has none's."""
    kept, out = list(kept), []
    taken, lower = {x.lower() for x in results}, {c.lower() for c in kept}
    for c in kept:
        name = c
        while name.lower() in taken or (name != c and name.lower() in lower):
            name += "_"
        out.append(name)
        taken.add(name.lower())
    return out


def quoted(c: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + c.replace("`", "``") + "`")


def one_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text), one row for each id: of several texts the one with the least hash. For few rows, such as those with a label."""
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))


def drawn_by_hash(known: DataFrame, column: str, most: dict) -> DataFrame:
    """Of known(doc_id, column) at most most[value] rows for each value, by hash of the id."""
    parts = [known.filter(F.col(column) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for v, n in most.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def whole(body: bytes | None) -> bytes:
    """Valid UTF-8: what is none becomes the replacement character; null is empty."""
    try:
        (body or b"").decode()
        return body or b""
    except UnicodeDecodeError:
        return body.decode("utf-8", "replace").encode()


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on the bytes of Arrow batches to BATCH_MB, unless it is lower (in bytes): always to the same value, so plans that run later keep it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if now != f"{BATCH_MB}m" and not (now.endswith("b") and 0 < int(now[:-1]) <= BATCH_MB << 20):
        spark.conf.set(key, f"{BATCH_MB}m")


def map_texts(df: DataFrame, per_batch: Callable[[dict, list[bytes | None]], dict], schema: str, keep: list[str | Column], text: str | Column = "text") -> DataFrame:
    """Runs per_batch(kept columns, UTF-8 texts) on Arrow batches of df[keep + text].

    per_batch gets the kept columns by name (Columns by position) and returns a dict with a list or array for each name in schema; the
    output has those columns only, so further columns of df, whatever their names, do no harm. A null text is None.
    """
    bounded_batches(df.sparkSession)
    names = StructType.fromDDL(schema).fieldNames()
    col = lambda c: quoted(c) if isinstance(c, str) else c
    source = df.select(*[col(c).alias(f"k{i}") for i, c in enumerate(keep)], col(text).cast("binary").alias("body"))
    named = [c if isinstance(c, str) else i for i, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                b = batch.slice(at, BATCH_ROWS)
                out = per_batch({c: b.column(i) for i, c in enumerate(named)}, b.column(len(named)).to_pylist())
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in (out[n] for n in names)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(run, schema)
