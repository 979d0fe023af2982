"""Connected components of an edge table, by alternating large-star and small-star rounds.

The edges stay distributed: every round is a minimum per node (partially aggregated, so that a hub
with a third of all edges sends one row per task) and a join back, both on written tables, where
Spark splits skewed keys. Rounds needed grow with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import Scratch

TASK_ROWS = 100_000  # rows of a written table that one task holds at least


def _minima(s: Scratch, both: DataFrame, few: int) -> DataFrame:
    return s.keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(few))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node has one parent at most and no parent has a parent."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    per_node = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return per_node.filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(s: Scratch, edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge; component = the smallest node it reaches.

    Loops and repeated edges are allowed; an empty edge table gives an empty result.
    """
    u, v = F.greatest(a, b).cast("bigint"), F.least(a, b).cast("bigint")
    e = s.keep(edges.select(u.alias("u"), v.alias("v")).filter("u <> v").distinct())
    few = e.count() // TASK_ROWS + 1  # tasks that write a round's tables, which hold about as many rows
    while not _is_forest_of_stars(e):
        # large star: each larger neighbour of u is linked to the least of u's neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        mins = _minima(s, both, few)
        large = s.keep(
            both.filter("v > u").join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(few)
        )
        s.drop(e, mins)
        # small star: u and its smaller neighbours are linked to the least of them
        mins = _minima(s, large, few)
        small = large.join(mins, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            mins.select("u", F.col("m").alias("v"))
        )
        e = s.keep(small.filter("u <> v").distinct().coalesce(few))
        s.drop(large, mins)
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
