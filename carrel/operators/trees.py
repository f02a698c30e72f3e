"""Hierarchies by parent pointers: closure, ancestors and rolled-up counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.operators import scans


def closure(edges: DataFrame, node: str, parent: str, save: Callable[[DataFrame, int], DataFrame], most_levels: int = 16) -> DataFrame:
    """(node, ancestor, depth): every node with itself (0) and all nodes above it.

    Each round joins the pairs found so far with themselves, so paths double in length and the
    rounds are the logarithm of the height. ``save`` writes a round's pairs and reads them back,
    which cuts the lineage. A cycle would pass the last level and fails.
    """
    up = edges.filter(F.col(parent).isNotNull()).select(F.col(node).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
    reach, longest = save(up, 0), 1
    while longest < most_levels:
        onward = reach.filter(F.col("depth") == longest).alias("a").join(reach.alias("b"), F.col("a.ancestor") == F.col("b.node")).select(F.col("a.node"), F.col("b.ancestor"), (F.col("a.depth") + F.col("b.depth")).alias("depth")).distinct()
        onward = save(onward, longest)
        if onward.isEmpty():
            break
        reach, longest = reach.unionByName(onward), 2 * longest
    deepest = reach.agg(F.max("depth")).first()[0] or 0
    if deepest >= most_levels:
        raise ValueError(f"the hierarchy has {deepest} levels or a cycle")
    own = edges.select(F.col(node).alias("node"), F.col(node).alias("ancestor"), F.lit(0).alias("depth"))
    return own.unionByName(reach).distinct()


def rolled_up(items: DataFrame, at: str, reach: DataFrame, value: str) -> DataFrame:
    """(ancestor, n, total) of items placed at nodes, over each node and all below it."""
    per = items.groupBy(F.col(at).alias("node")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return per.join(reach, "node").groupBy("ancestor").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def numbered(edges: DataFrame, node: str, parent: str, reach: DataFrame) -> DataFrame:
    """(node, depth, first, last): places in a walk down the tree; what stands below a node has its ``first`` from first to last.

    reach: the closure of the same edges, of which a node has one parent. A node stands behind its parent by
    one and by what stands below the siblings before it; sums of these along the closure give its place. Siblings stand in the order of a
    hash and are added up by ranges of it, so a parent of very many children is dealt over tasks.
    """
    sizes = reach.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("size"))
    kids = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")).join(sizes, "node")
    kids = kids.withColumn("_order", F.shiftrightunsigned(F.xxhash64("node"), 1))
    summed = scans.running_sums(kids, {"_before": F.col("size")}, "parent", "_order", span=1 << 53)
    steps = summed.select(F.col("node").alias("ancestor"), (F.col("_before") - F.col("size") + F.col("parent").isNotNull().cast("int")).alias("step"))
    first = reach.join(steps, "ancestor").groupBy("node").agg(F.sum("step").alias("first"), F.max("depth").alias("depth"))
    return first.join(sizes, "node").select("node", "depth", "first", (F.col("first") + F.col("size") - 1).alias("last"))


def below(tree: DataFrame, depth: int) -> DataFrame:
    """(node, top): the node of a depth that each node stands at or below; those above it have none.

    Nodes of one depth hold ranges apart from each other, so the last of them that begins at or before a
    node is the only one that can hold it.
    """
    top = F.when(F.col("depth") == depth, F.struct(F.col("node").alias("node"), F.col("last").alias("last")))
    told = scans.last_filled(tree.withColumn("_tree", F.lit(0)), top, "_top", "_tree", "first")
    return told.filter(F.col("first") <= F.col("_top.last")).select("node", F.col("_top.node").alias("top"))


def broadest(matches: DataFrame, tree: DataFrame, id_: str = "id", at: str = "node") -> DataFrame:
    """(id, node): of the nodes that a vague record may mean the broadest, of equally broad ones the first of the walk."""
    told = matches.select(F.col(id_).alias("id"), F.col(at).alias("node")).join(tree, "node")
    return told.groupBy("id").agg(F.min_by("node", F.struct("depth", "first")).alias("node"))
