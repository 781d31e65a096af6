"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.base import apart
from riskloom.sources.scratch import checkpointed


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (node, centre) form stars already: one centre a node, and no centre is a node."""
    nodes = edges.groupBy("u").agg(F.count("*").alias("n"))
    if nodes.where("n > 1").limit(1).count():
        return False
    return not edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi").limit(1).count()


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(id, component)`` for every node that has an edge; the component is its smallest node.

    Edges are undirected longs; loops, repeats and nulls are ignored, and no edges give no rows.
    A round replaces edges by edges to smaller neighbours (partial minima first, so a hub does not
    meet in one task; its join is left to skew splitting). Rounds grow with the logarithm of the
    longest path; each is checkpointed, so a lost executor repeats one round at most.
    """
    u, v = F.col(left), F.col(right)
    now = checkpointed(edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    while not _settled(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(apart(low, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(lowest, "u"), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct())
    centres = now.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
