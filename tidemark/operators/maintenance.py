"""Compaction, rewriting and retention of stored tables."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .filters import interval


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def swap(spark: SparkSession, path: str, new: str | None) -> None:
    """Puts the folder new in the place of path, whose old content goes last; without new it only removes path."""
    fs, p = _fs(spark, path)
    if new is None:
        fs.delete(p, True)
        return
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    if not fs.rename(p, old):
        raise OSError(f"can't rename {path}")
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(new), p):
        fs.rename(old, p)
        raise OSError(f"can't rename {new}")
    fs.delete(old, True)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def replace_partitions(spark: SparkSession, df: DataFrame, path: str, keys: list[str], touched: list[tuple] | None = None) -> None:
    """Puts df's partitions in the place of those at path; others keep their files. df may read from path.

    df is written beside path first, rows of a partition together but a large one in several tasks, then each of its partitions' folders takes the old one's place by a rename. Of touched, the values of partitions that df stands
    for, those that it has no rows for go.
    """
    beside = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    df.hint("rebalance", *keys).write.partitionBy(*keys).parquet(beside)
    fs, new = _fs(spark, beside)
    root, trash = _fs(spark, path)[1], _fs(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")[1]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folders = [s.getPath() for s in fs.globStatus(hadoop(new, "/".join(f"{k}=*" for k in keys))) or ()]
    names = ["/".join(str(f.toString()).split("/")[-len(keys) :]) for f in folders]
    gone = {"/".join(f"{k}={v}" for k, v in zip(keys, values, strict=True)) for values in touched or ()} - set(names)
    fs.mkdirs(trash)
    for n, name in enumerate([*names, *sorted(gone)]):
        target = hadoop(root, name)
        if fs.exists(target) and not fs.rename(target, hadoop(trash, str(n))):
            raise OSError(f"can't move {name} of {path}")
        if name not in gone:
            fs.mkdirs(target.getParent())
            if not fs.rename(hadoop(new, name), target):
                raise OSError(f"can't place {name} in {path}")
    fs.delete(trash, True)
    fs.delete(new, True)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file; it is there whole or not at all."""
    fs, p = _fs(spark, path)
    part = _fs(spark, path + ".part")[1]
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"can't write {path}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def needs_compaction(df: DataFrame, limit: int = 10) -> bool:
    """Whether df's table has more files than limit; Spark has their list on the driver to plan a scan."""
    return len(df.inputFiles()) > limit


def _replace(spark: SparkSession, path: str, df: DataFrame, keys: list[str]) -> None:
    """Writes df beside path, compares the counts, then swaps."""
    new = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*keys) if keys else df.write
    writer.parquet(new)
    if spark.read.parquet(new).count() != spark.read.parquet(path).count():
        swap(spark, new, None)
        raise RuntimeError(f"the rewritten {path} has another number of rows; the old one stays")
    swap(spark, path, new)


def compact(spark: SparkSession, path: str, files: int = 10, keys: list[str] | None = None) -> bool:
    """Rewrites a table in few files: so many in all, or one to a partition. False if it has no more already.

    All partitions are rewritten in one job, and the old table goes only when the new one is whole.
    """
    df = spark.read.parquet(path)
    parts = df.select(*keys).distinct().count() if keys else files
    if not needs_compaction(df, parts):
        return False
    _replace(spark, path, df.repartition(*keys) if keys else df.coalesce(files), keys or [])
    return True


def small_groups(spark: SparkSession, path: str, target: int, small: float) -> DataFrame:
    """(folder, g, files, bytes): the small files of each folder, packed in the order of their names into groups of about target bytes; groups of one are left out.

    The files are listed by tasks (their contents aren't read), so the driver needn't hold the list of a table's files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    files = files.filter(F.col("length") < int(target * small)).withColumn("folder", F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    before = F.sum("length").over(Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    packed = files.withColumn("g", F.floor(F.coalesce(before, F.lit(0)) / target))
    return packed.groupBy("folder", "g").agg(F.sort_array(F.collect_list("path")).alias("files"), F.sum("length").alias("bytes")).filter(F.size("files") > 1)


def _finish(spark: SparkSession, path: str) -> None:
    """Does what is left of the intent of a compaction: new files to their folders, then old ones go."""
    intent, staging = f"{path}/_compaction.intent", f"{path}/_compaction"
    if exists(spark, intent):
        fs, _ = _fs(spark, path)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        todo = json.loads(_read_text(spark, intent))
        for a, b in todo["moves"]:
            if fs.exists(hadoop(a)) and not fs.rename(hadoop(a), hadoop(b)):
                raise OSError(f"can't move {a}")
        for old in todo["old"]:
            fs.delete(hadoop(old), False)
        fs.delete(hadoop(intent), False)
    remove(spark, staging)


def compact_small(spark: SparkSession, path: str, target: int = 128 << 20, small: float = 0.75, groups: int = 100) -> int:
    """Joins the small files of a table, of any partitions, into files of about target bytes; how many files went.

    A file of small * target bytes or more is not touched. Each group of files goes to one task and becomes one file in its folder, so a large partition takes many
    tasks. So many groups are rewritten at a time; then rows are counted, an intent is noted, new files are moved in and old ones deleted. A run that dies after
    the intent is finished by the next. Nobody should read the table between the moves and the deletes.
    """
    path = path.rstrip("/")
    _finish(spark, path)
    table, gone = spark.read.parquet(path), 0
    folders = {k for f in table.inputFiles()[:1] for k in (x.partition("=")[0] for x in f.split("/")[:-1] if "=" in x)}
    schema = StructType([f for f in table.schema if f.name not in folders])
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    waiting: list = []

    def rewrite() -> int:
        if not waiting:
            return 0
        staging = f"{path}/_compaction"
        parts = [spark.read.schema(schema).parquet(*r["files"]).withColumn("joined_group", F.lit(i)) for i, r in enumerate(waiting)]
        out = parts[0]
        for x in parts[1:]:
            out = out.union(x)
        # a task to a group; which group a file is of is known by its folder
        out.repartitionById(len(waiting), F.col("joined_group")).write.partitionBy("joined_group").parquet(staging)
        fs, root = _fs(spark, staging)
        moves = []
        for status in fs.globStatus(hadoop(root, "joined_group=*/part-*")) or ():
            p = status.getPath()
            i = int(p.getParent().getName().partition("=")[2])
            moves.append((p.toString(), f"{waiting[i]['folder']}/joined-{uuid.uuid4().hex}.parquet"))
        old = [f for r in waiting for f in r["files"]]
        if spark.read.schema(schema).parquet(staging).count() != spark.read.schema(schema).parquet(*old).count():
            fs.delete(hadoop(staging), True)
            raise RuntimeError(f"joined files of {path} have another number of rows; the old ones stay")
        _write_text(spark, f"{path}/_compaction.intent", json.dumps({"moves": moves, "old": old}))
        _finish(spark, path)
        waiting.clear()
        return len(old)

    for row in small_groups(spark, path, target, small).orderBy("folder", "g").toLocalIterator():
        waiting.append(row)
        if len(waiting) >= groups:
            gone += rewrite()
    return gone + rewrite()


def rewrite_by(df: DataFrame, keys: list[str], path: str) -> None:
    """Writes df to a new path by keys, which come last."""
    rest = [c for c in df.columns if c not in keys]
    df.select(*rest, *keys).hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def expire(spark: SparkSession, path: str, span: str = "1 year", now: datetime | None = None, day: str = "day") -> int:
    """Removes the partitions that end before now less span, and returns their number; other files are not touched.

    Partitions are by the date named by day, by year/month/day or by year/month; they are known by their folders' names, so no file is read.
    """
    cutoff = ((now or datetime.now()) - interval(span)).date()
    fs, p = _fs(spark, path)
    gone = 0
    for keys in ((day,), ("year", "month"), ("year", "month", "day")):  # months first, while those that have days still have them
        pattern = spark._jvm.org.apache.hadoop.fs.Path(p, "/".join(f"{k}=*" for k in keys))
        for status in fs.globStatus(pattern) or ():
            folder = status.getPath()
            values = [x.partition("=")[2] for x in str(folder.toString()).split("/")[-len(keys) :]]
            if "__HIVE_DEFAULT_PARTITION__" in values:
                continue
            if len(keys) == 1:
                last = date.fromisoformat(values[0]) if "-" in values[0] else None
            elif len(keys) == 3:
                last = date(*map(int, values))
            elif fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "day=*")):
                last = None  # its days go one by one
            else:
                y, m = map(int, values)
                last = date(y + m // 12, m % 12 + 1, 1) - timedelta(days=1)
            if last and last < cutoff:
                fs.delete(folder, True)
                gone += 1
    return gone
