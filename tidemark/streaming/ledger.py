"""A sink that takes each batch of a stream once, by a ledger of batch ids that is kept with the data."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.maintenance import _fs, _read_text, _write_text, exists, remove


class Ledger:
    """Batches of the stream called name in the table at path.

    A batch is written to a hidden folder first. Then its intent is noted: which file goes where. Then the files are moved, then the intent becomes the
    batch's entry. A batch that comes again is known by its entry; one that died before its intent is written anew; one that died after it is carried on. So nothing is
    doubled or lost, and the stored rows are never read. Names must differ between streams, and a stream that starts from a new checkpoint needs a new name.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "stream"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def _at(self, kind: str, batch: int) -> str:
        return f"{self.path}/_ledger/{self.name}/{batch}.{kind}"

    def _staging(self, batch: int) -> str:
        return f"{self.path}/_staging/{self.name}/{batch}"

    def done(self, batch: int) -> bool:
        return exists(self.spark, self._at("done", batch))

    def _stage(self, df: DataFrame, batch: int, partitions: list[str]) -> None:
        remove(self.spark, self._staging(batch))
        df.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(self._staging(batch))
        fs, root = _fs(self.spark, self._staging(batch))
        files, moves = fs.listFiles(root, True), []
        base = root.toUri().getPath().rstrip("/") + "/"
        while files.hasNext():  # the files of one batch
            p = files.next().getPath()
            where = p.toUri().getPath()[len(base) :]
            folder, _, last = where.rpartition("/")
            if not last.startswith(("_", ".")):
                moves.append((where, f"{folder}/{self.name}-{batch}-{len(moves)}.parquet".lstrip("/")))
        _write_text(self.spark, self._at("intent", batch), json.dumps(moves))

    def _carry(self, batch: int) -> None:
        """Moves what the intent says and hasn't been moved yet, then enters the batch."""
        fs, _ = _fs(self.spark, self.path)
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        for a, b in json.loads(_read_text(self.spark, self._at("intent", batch))):
            self._move(fs, hadoop(f"{self._staging(batch)}/{a}"), hadoop(f"{self.path}/{b}"))
        if not fs.rename(hadoop(self._at("intent", batch)), hadoop(self._at("done", batch))):
            raise OSError(f"can't enter batch {batch}")
        remove(self.spark, self._staging(batch))

    def _move(self, fs, source, target) -> None:
        if fs.exists(source):
            fs.mkdirs(target.getParent())
            if not fs.rename(source, target):
                raise OSError(f"can't move {source}")

    def write(self, df: DataFrame, batch: int, partitions: list[str]) -> bool:
        """Stores df as a batch; False if it had been stored."""
        if self.done(batch):
            return False
        if not exists(self.spark, self._at("intent", batch)):
            self._stage(df, batch, partitions)
        self._carry(batch)
        return True


def write_once(path: str, keys: list[str], partitions: list[str], name: str = "stream", order: str | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: each batch once, of the rows of a batch with the same key one, the last by order (else by all other columns).

    What other batches have stored isn't looked at; write_new does that.
    """

    def write(batch: DataFrame, i: int) -> None:
        ledger = Ledger(batch.sparkSession, path, name)
        rest = [c for c in batch.columns if c not in keys]
        row, by = F.struct(*rest), F.col(order) if order else F.struct(*rest)
        one = batch.groupBy(*keys).agg(F.max_by(row, by).alias("_row")).select(*keys, "_row.*") if rest else batch.select(*keys).distinct()
        ledger.write(one.select(*batch.columns), i, partitions)

    return write
