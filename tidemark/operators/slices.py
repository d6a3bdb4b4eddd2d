"""Windows over long series, by slices with a halo: no task gets a whole series.

A series is cut into slices of consecutive rows. The rows that a slice's first windows look back on are copied to it from the slices before (its halo),
windows run within slices, and the halo's own results go. For windows of rows the copies are chosen by counts, since gaps make time no measure of rows; for
windows of time by time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .filters import interval

SLICE_ROWS = 20_000
Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def _seconds(ts: str) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def row_slices(df: DataFrame, by: str, ts: str, back: int, rows: int, cell: str) -> DataFrame:
    """(_by, _cell, _slice, _targets): the slice of each cell of time, and the slices that need rows of its slice, with the rows that lie between.

    Cells are counted, their counts added up along each series, and a slice takes cells until it has about so many rows. Only cells and slices are sorted by series here.
    """
    cells = df.groupBy(F.col(by).alias("_by"), F.floor(_seconds(ts) / int(interval(cell).total_seconds())).alias("_cell")).agg(F.count("*").alias("_n"))
    along = Window.partitionBy("_by").orderBy(F.col("_cell").asc_nulls_first())
    before = F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.withColumn("_slice", F.floor(before / rows))
    slices = cells.groupBy("_by", "_slice").agg(F.sum("_n").alias("_m"))
    order = Window.partitionBy("_by").orderBy("_slice")
    slices = slices.withColumn("_end", F.sum("_m").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # a slice has a row at least, so those that may need rows of this one are the next so many at most
    later = F.collect_list(F.struct(F.col("_slice").alias("slice"), (F.col("_end") - F.col("_m")).alias("start"))).over(order.rowsBetween(1, back))
    near = F.filter(F.transform(later, lambda x: F.struct(x["slice"].alias("slice"), (x["start"] - F.col("_end")).alias("between"))), lambda x: x["between"] < back)
    slices = slices.select(F.col("_by").alias("_by2"), F.col("_slice").alias("_slice2"), near.alias("_targets"))
    return cells.join(slices, F.col("_by").eqNullSafe(F.col("_by2")) & (F.col("_slice") == F.col("_slice2"))).select("_by", "_cell", "_slice", "_targets")


def over_rows(df: DataFrame, by: str, ts: str, back: int, compute: Compute, rows: int | None = SLICE_ROWS, cell: str = "1 day") -> DataFrame:
    """compute(df, window), where the window is by series and time and nothing in compute looks back more than so many rows.

    The result is that of one window over each series. df is read twice, for counts and for rows: give what is stored. Rows must be told apart by their series and time. rows=None does without slices.
    A slice has about so many rows; more only where a cell of time has more.
    """
    if rows is None or back < 1:
        return compute(df, Window.partitionBy(by).orderBy(ts))
    names = df.columns
    where = row_slices(df, by, ts, back, rows, cell)
    number = F.floor(_seconds(ts) / int(interval(cell).total_seconds()))
    placed = df.join(where, F.col(by).eqNullSafe(F.col("_by")) & number.eqNullSafe(F.col("_cell")))
    slices = Window.partitionBy(by, "_slice")
    placed = placed.withColumn("_rank", F.row_number().over(slices.orderBy(F.col(ts).desc())))
    # a row goes to its own slice, and as halo to those whose first row looks back as far as to it
    wanted = F.filter("_targets", lambda x: x["between"] + F.col("_rank") <= back)
    own = F.array(F.struct(F.col("_slice").alias("slice"), F.lit(False).alias("halo")))
    copies = F.when(F.col("_rank") <= back, F.concat(own, F.transform(wanted, lambda x: F.struct(x["slice"].alias("slice"), F.lit(True).alias("halo"))))).otherwise(own)
    dealt = placed.select(*names, F.explode(copies).alias("_to")).select(*names, F.col("_to.slice").alias("_slice"), F.col("_to.halo").alias("_halo"))
    out = compute(dealt, slices.orderBy(ts))
    return out.filter(~F.col("_halo")).drop("_slice", "_halo")


def over_time(df: DataFrame, by: str, ts: str, back: str, compute: Compute, span: str | None = "30 days") -> DataFrame:
    """compute(df, window), where the window is by series and ordered by seconds, and nothing in compute looks back further than a span of time.

    Slices are spans of time, not shorter than what is looked back; the last rows of each are copied to the next. span=None does without slices.
    """
    if span is None:
        return compute(df, Window.partitionBy(by).orderBy(_seconds(ts)))
    names, look = df.columns, int(interval(back).total_seconds())
    wide = max(look, int(interval(span).total_seconds()))
    number = F.floor(_seconds(ts) / wide)
    own = F.struct(number.alias("slice"), F.lit(False).alias("halo"))
    halo = F.struct((number + 1).alias("slice"), F.lit(True).alias("halo"))
    copies = F.when(_seconds(ts) >= (number + 1) * wide - look, F.array(own, halo)).otherwise(F.array(own))
    dealt = df.select(*names, F.explode(copies).alias("_to")).select(*names, F.col("_to.slice").alias("_slice"), F.col("_to.halo").alias("_halo"))
    out = compute(dealt, Window.partitionBy(by, "_slice").orderBy(_seconds(ts)))
    return out.filter(~F.col("_halo")).drop("_slice", "_halo")
