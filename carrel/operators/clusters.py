"""Identity clusters from pair links, and how well clusters agree with a gold standard."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.sources.staging import stage


def min_label(nodes: DataFrame, links: DataFrame, save: Callable[[DataFrame, int], DataFrame], most_rounds: int = 40) -> DataFrame:
    """(id, cluster): the smallest id reachable by links (a, b), both ways.

    Each round takes the smallest label among neighbours and then that label's own label, so labels
    travel twice as far each time. ``save`` writes a round's table and reads it back, which cuts
    the lineage; its number is that of the round. Labels are merged, not broadcast: files of numbers look small
    beside their rows, and each round would send these through the driver.
    """
    both = save(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), -1)
    labels = save(nodes.select("id", F.col("id").alias("cluster")), 0)
    for i in range(1, most_rounds + 1):
        near = both.join(labels.hint("merge"), F.col("b") == F.col("id")).groupBy("a").agg(F.min("cluster").alias("near"))
        stepped = labels.join(near.hint("merge"), F.col("id") == F.col("a"), "left").select("id", F.least("cluster", "near").alias("cluster"))
        hop = stepped.select(F.col("id").alias("cluster"), F.col("cluster").alias("further"))
        moved = save(stepped.join(hop.hint("merge"), "cluster", "left").select("id", F.least("cluster", "further").alias("cluster")), i)
        changed = moved.alias("m").join(labels.alias("l").hint("merge"), "id").filter("m.cluster <> l.cluster").isEmpty()
        labels = moved
        if changed:
            return labels
    raise ValueError(f"labels still change after {most_rounds} rounds")


def constrained(nodes: DataFrame, links: DataFrame, cannot: DataFrame | None = None, exclusive: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Clusters that hold no forbidden pair: ((id, cluster), refused links (a, b, weight, reason)).

    links: (a, b, weight); cannot: (a, b) that may not be together; exclusive: (id, key), of which no
    cluster may hold two ids of one key, as two rows of one source. Links are taken from the greatest weight
    on, of equal ones by a hash of their ends, and a link that would bring a forbidden pair together is refused.

    That order needs no sequence: where a link is the first of all that leave both of its clusters,
    nothing can change these before it comes up. So each round decides all such links, by joins with the
    constraints between clusters, merges or refuses, and names merged clusters anew. Components in which nothing is forbidden are
    merged at once. Links of an end that is no node, of a null end, or of a node with itself are left out; constraints of
    an id with itself forbid nothing.
    """
    spark = nodes.sparkSession
    kind = nodes.schema["id"].dataType.simpleString()
    ids = nodes.select("id").filter("id is not null").distinct()
    if cannot is None:
        cannot = spark.createDataFrame([], f"a {kind}, b {kind}")
    if exclusive is None:
        exclusive = spark.createDataFrame([], f"id {kind}, key string")
    pairs = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("weight").cast("double").alias("weight"))
    for end in ("a", "b"):
        pairs = pairs.join(ids.withColumnRenamed("id", end).hint("merge"), end, "left_semi")
    pairs = stage(pairs.groupBy("a", "b").agg(F.max("weight").alias("weight")), "constrained-links")
    apart = stage(cannot.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "constrained-cannot")
    keys = stage(exclusive.filter("key is not null").select("id", "key").distinct(), "constrained-keys")

    def between(labels: DataFrame, rows: DataFrame) -> DataFrame:
        """Rows with ends a and b, and the clusters ca < cb of these, where they differ."""
        told = rows.join(labels.select(F.col("id").alias("a"), F.col("cluster").alias("_x")).hint("merge"), "a").join(labels.select(F.col("id").alias("b"), F.col("cluster").alias("_y")).hint("merge"), "b")
        return told.filter("_x <> _y").withColumn("ca", F.least("_x", "_y")).withColumn("cb", F.greatest("_x", "_y")).drop("_x", "_y")

    whole = stage(min_label(ids, pairs, lambda df, i: stage(df, "constrained-round")), "constrained-whole")
    bad_pairs = apart.join(whole.select(F.col("id").alias("a"), "cluster").hint("merge"), "a").join(whole.select(F.col("id").alias("b"), F.col("cluster").alias("_other")).hint("merge"), "b").filter("cluster = _other").select("cluster")
    bad_keys = keys.join(whole.hint("merge"), "id").groupBy("cluster", "key").count().filter("count > 1").select("cluster")
    bad = stage(bad_pairs.unionByName(bad_keys).distinct(), "constrained-bad")
    free = whole.join(bad.hint("merge"), "cluster", "left_anti").select("id", "cluster")
    labels = stage(whole.join(bad.hint("merge"), "cluster", "left_semi").select("id", F.col("id").alias("cluster")), "constrained-labels")
    open_ = stage(pairs.join(labels.select(F.col("id").alias("a")).hint("merge"), "a", "left_semi"), "constrained-open")
    refused = []
    while True:
        told = stage(between(labels, open_), "constrained-told")
        if told.isEmpty():
            break
        first = told.groupBy("ca", "cb").agg(F.max(F.struct("weight", F.xxhash64("a", "b").alias("h"), "a", "b")).alias("top"))
        ends = first.select(F.col("ca").alias("c"), "top", "ca", "cb").unionByName(first.select(F.col("cb").alias("c"), "top", "ca", "cb"))
        mine = ends.groupBy("c").agg(F.max(F.struct("top", "ca", "cb")).alias("m"))
        due = stage(mine.groupBy("m.ca", "m.cb").count().filter("count = 2").select("ca", "cb"), "constrained-due")
        by_pair = between(labels, apart).select("ca", "cb", F.lit("cannot").alias("reason")).distinct()
        held = keys.join(labels.hint("merge"), "id").select("cluster", "key").distinct()
        by_key = due.join(held.select(F.col("cluster").alias("ca"), "key").hint("merge"), "ca").join(held.select(F.col("cluster").alias("cb"), "key").hint("merge"), ["cb", "key"]).select("ca", "cb", F.lit("exclusive").alias("reason")).distinct()
        judged = stage(due.join(by_pair.unionByName(by_key).groupBy("ca", "cb").agg(F.min("reason").alias("reason")).hint("merge"), ["ca", "cb"], "left"), "constrained-judged")
        gone = told.join(judged.filter("reason is not null").hint("merge"), ["ca", "cb"]).select("a", "b", "weight", "reason")
        refused.append(stage(gone, "constrained-refused"))
        open_ = stage(told.join(judged.hint("merge"), ["ca", "cb"], "left_anti").select("a", "b", "weight"), "constrained-open")
        moved = judged.filter("reason is null").select(F.col("cb").alias("cluster"), F.col("ca").alias("_to"))
        labels = stage(labels.join(moved.hint("merge"), "cluster", "left").select("id", F.coalesce("_to", "cluster").alias("cluster")), "constrained-labels")
    out = spark.createDataFrame([], f"a {kind}, b {kind}, weight double, reason string")
    for one in refused:
        out = out.unionByName(one)
    return free.unionByName(labels), out


def by_equal(rows: DataFrame, id_: str, value: str) -> DataFrame:
    """(id, cluster): rows of an equal value, without links between them."""
    least = rows.groupBy(F.col(value).alias("_v")).agg(F.min(id_).alias("cluster"))
    return rows.join(least, F.col(value).eqNullSafe(F.col("_v"))).select(F.col(id_).alias("id"), "cluster")


def pair_scores(found: DataFrame, gold: DataFrame) -> DataFrame:
    """Pairwise precision, recall and F1 of (id, cluster) against (id, cluster), over ids of both.

    Pairs are counted by cell sizes of the two partitions; no pair is made.
    """
    both = found.join(gold.withColumnRenamed("cluster", "gold"), "id")

    def pairs(name: str, *keys: str) -> DataFrame:
        return both.groupBy(*keys).agg(F.count("*").alias("n")).select(F.lit(name).alias("of"), (F.col("n") * (F.col("n") - 1) / 2).alias("p"))

    every = pairs("tp", "cluster", "gold").unionByName(pairs("fp", "cluster")).unionByName(pairs("fn", "gold"))
    one = every.agg(*(F.sum(F.when(F.col("of") == name, F.col("p"))).alias(name) for name in ("tp", "fp", "fn")))
    precision, recall = F.try_divide("tp", "fp"), F.try_divide("tp", "fn")
    return one.select(precision.alias("precision"), recall.alias("recall"), F.try_divide(2 * precision * recall, precision + recall).alias("f1"))


def b_cubed(found: DataFrame, gold: DataFrame) -> DataFrame:
    """B-cubed precision, recall and F1, by cell sizes of the two partitions."""
    cells = found.join(gold.withColumnRenamed("cluster", "gold"), "id").groupBy("cluster", "gold").agg(F.count("*").alias("n"))
    own = cells.groupBy("cluster").agg(F.sum("n").alias("n_own"))
    true = cells.groupBy("gold").agg(F.sum("n").alias("n_gold"))
    n = F.sum("n")
    scores = cells.join(own, "cluster").join(true, "gold").agg((F.sum(F.col("n") * F.col("n") / F.col("n_own")) / n).alias("precision"), (F.sum(F.col("n") * F.col("n") / F.col("n_gold")) / n).alias("recall"))
    return scores.withColumn("f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def abstention(universe: DataFrame, found: DataFrame) -> DataFrame:
    """(total, assigned, abstained, rate) over a closed universe of ids, of which some have no cluster."""
    ids = universe.select("id").distinct().join(found.select("id").distinct().withColumn("_there", F.lit(1)), "id", "left")
    counts = ids.agg(F.count("*").alias("total"), F.count("_there").alias("assigned"))
    return counts.withColumn("abstained", F.col("total") - F.col("assigned")).withColumn("rate", F.try_divide("abstained", "total"))


def split_pairs(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
    """Pairs (a, b) known to be the same that stand in different clusters."""
    a = clusters.select(F.col("id").alias("a"), F.col("cluster").alias("_ca"))
    b = clusters.select(F.col("id").alias("b"), F.col("cluster").alias("_cb"))
    return pairs.join(a, "a", "left").join(b, "b", "left").filter(~F.col("_ca").eqNullSafe(F.col("_cb"))).select("a", "b")


def escalate(pairs: DataFrame, checks: list[tuple[str, str]]) -> DataFrame:
    """Adds outcome: the first check (name, condition) that forbids a link, else ``link``."""
    out = F.lit("link")
    for name, condition in reversed(checks):
        out = F.when(F.coalesce(F.expr(condition), F.lit(False)), name).otherwise(out)
    return pairs.withColumn("outcome", out)
