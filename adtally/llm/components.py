"""Connected components of an edge table by alternating star operations.

A large star points each node's larger neighbours at the least node around it, a small star
does so with the smaller ones, until every component is a star around its least node, which one
aggregate tells. Each step is an aggregate and a join on the node; a hub's edges are split by
the adaptive skew join. Edges live in the shared folder between steps and never on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import Stages


def _large_star(edges: DataFrame) -> DataFrame:
    """A row for each edge, so that rows don't grow; repeated ones end with the small star."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("of")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    moved = edges.join(least, F.col("u") == F.col("of")).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("of").alias("u"), F.col("m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether no node of these distinct edges has two lesser neighbours, or a lesser one and a larger one."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg((F.sum("up") + F.max("down")).alias("ends")).where("ends > 1").isEmpty()


def components(edges: DataFrame, stages: Stages) -> DataFrame:
    """``node, component`` for every node of ``a, b`` edges that is not the least of its component.

    The edges are read several times, so they should come from a written table.
    """
    now, own = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), []
    done = now.isEmpty()
    while not done:
        half = stages.write(_large_star(now), "large-star")
        now = stages.write(_small_star(half), "small-star")
        stages.drop(half, *own)
        own, done = [now], _are_stars(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
