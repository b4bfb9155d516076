"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node of each node's component: `node`, `root`, one row per node that has an edge.

    `edges` has columns `src` and `dst` of one type; loops, repeats and either direction are fine, rows with nulls are
    not edges, and no edges give no rows.

    Each round links every node to the smallest of its neighbours, first the larger neighbours (large star), then the
    smaller ones (small star). Rounds are written to the shared folder, which also cuts the lineage; the number of
    rounds grows with the logarithm of the longest path. A node's neighbours are only ever reduced to their minimum,
    before the shuffle, and joined back by an equi-join that adaptive execution splits where a hub is large.
    """
    ends = [F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("root")]
    stars = stage(edges.where("src <> dst").select(*ends).distinct(), "edges")
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
        before = now
        stars = stage(_small_star(_large_star(stars)), "stars")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest node among its neighbours and itself."""
    both = edges.union(edges.select("root", "node")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select(F.col("node").alias("center"), F.least("node", "least").alias("least"))
    linked = both.join(least, F.col("node") == F.col("center"))
    return linked.where("other > node").select(F.col("other").alias("node"), F.col("least").alias("root")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node's smaller neighbours, and itself, to the smallest of them."""
    least = edges.groupBy(F.col("node").alias("center")).agg(F.min("root").alias("least"))
    linked = edges.join(least, F.col("node") == F.col("center"))
    moved = linked.where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    return moved.union(least.select("center", "least")).distinct()
