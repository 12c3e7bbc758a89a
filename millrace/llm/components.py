"""Connected components by alternating large-star and small-star steps, in SQL.

Each step hangs nodes on the smallest neighbour they know.  Edges are written to the shared
folder after every round, so that a lost executor costs one round at most; the round before is then
deleted.  Groups
are reduced by map-side minima; a node with very many edges is only a frequent join key,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a > b): every node's neighbours move to the node's minimum."""
    if large:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = seen.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = seen.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        moved = (
            seen.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        ).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.filter("a > b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the least node it can reach.

    Loops and nulls are dropped; links may repeat and point either way; no links give no
    rows."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    scratch = Scratch(links.sparkSession)
    edges = scratch.keep(edges, "links")
    mark = _mark(edges)
    while mark[0]:
        edges = scratch.keep(_star(_star(edges, True), False), "links")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select("node", F.col("node").alias("label"))
    )
