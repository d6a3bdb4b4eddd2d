"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _done(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u itself."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("x"), F.lit(1).alias("is_u")), F.struct(F.col("v").alias("x"), F.lit(0).alias("is_u")))).alias("e"))
    nodes = ends.groupBy("e.x").agg(F.sum("e.is_u").alias("n"), F.min("e.is_u").alias("least"))
    return not nodes.agg(F.count_if((F.col("n") > 1) | ((F.col("n") == 1) & (F.col("least") == 0)))).first()[0]


def components(links: DataFrame, tables: Scratch | None = None) -> DataFrame:
    """(node, component) for every node of links(u, v); component is the smallest node that can be reached.

    Each step joins the links with the least neighbour of their nodes, so no group is gathered anywhere, and writes
    its result to the shared folder (as tables, "edges"). The driver sees counts. Self links and nulls are ignored; no links give no rows.
    """
    tables = tables or Scratch(links.sparkSession)
    edges = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    edges = tables.keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _done(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))  # repeats go below
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = tables.keep(small.select("e.*").filter("u <> v").distinct(), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
