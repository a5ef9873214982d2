"""Connected components of an edge table, by alternating large and small stars.

Each round replaces edges by edges to smaller nodes (Kiveris et al., Connected
Components in MapReduce and Beyond); the table never grows and is written once
a round. All joins meet one row on one side, and AQE can split a hub's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nearfold.sources.scratch import stage


def _least(edges: DataFrame) -> DataFrame:
    """``(u, _m)``: the least neighbour of each node.

    The node is computed anew, so that the join to come shuffles this side too:
    AQE splits a hub's partition only between two plain exchanges.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("_m"))
    return least.select(F.col("u").bitwiseXOR(F.lit(0)).alias("u"), "_m")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    joined = both.where("v > u").join(_least(both).hint("merge"), "u")
    return joined.select(F.col("v").alias("u"), F.least("_m", "u").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as (larger, smaller)."""
    least = _least(edges)
    joined = edges.join(least.hint("merge"), "u").where("v <> _m")
    star = joined.select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return star.union(least.select("u", F.col("_m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).head()
    )


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; component: its least node."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = stage(edges.distinct(), "component-edges")
    before = _state(edges)
    while before[0]:
        edges = stage(_small_star(_large_star(edges)), "component-edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )
