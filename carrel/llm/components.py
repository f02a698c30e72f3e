"""Connected components by alternating large-star and small-star rounds.

Each round is joins and minimum aggregates over the edge table; the driver only sees three numbers
a round. The edge table of every round is written to the shared folder.

A node's edges are counted before they move, and joined to what was counted, so that a node with very many is
split over tasks. In a table of few edges (``staging.TASK_ROWS``) no node has many: there a star is one window, one shuffle for two or three.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carrel.sources.staging import TASK_ROWS, stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours. moved: whether that is another one."""
    all_ways = _both_ways(edges)
    least = all_ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _once(all_ways.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"), F.expr("m < a").alias("moved")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours, which its edges (a, b) lead to, to the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.max("moved").alias("moved"))
    others = edges.select("a", "b").join(least.select("a", "m"), "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"), F.lit(True).alias("moved"))
    return _once(others.unionByName(least.select("a", F.col("m").alias("b"), "moved")))


def _both_stars(edges: DataFrame) -> DataFrame:
    """A large star and a small one of few edges; each gives no more edges than it gets."""
    least = F.min("b").over(Window.partitionBy("a"))
    large = _both_ways(edges).withColumn("m", F.least("a", least)).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"), F.expr("m < a").alias("moved"))
    return large.withColumn("m", least).select(F.expr("if(b > m, b, a)").alias("a"), F.col("m").alias("b"), F.expr("moved or b > m").alias("moved"))


def _once(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a", "b").agg(F.max("moved").alias("moved"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for each end of ``edges`` (a, b of type long): component is its smallest node."""
    now = stage(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    rows = now.count()
    moved = rows > 0
    while moved:
        now = stage(_both_stars(now) if rows <= TASK_ROWS else _small_star(_large_star(now)), "edges")
        rows, moved = now.agg(F.count("*"), F.coalesce(F.max("moved"), F.lit(False))).first()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
