"""Proof queries of claims and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.operators import claims
from carrel.plans.registry import Book
from carrel.sources.staging import load

book = Book()


@book.query("""
SELECT p_partkey AS subject, 'brand' AS predicate, p_brand AS value, 'a' AS actor FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR), 'a' FROM part WHERE p_size % 2 = 0""")
def claims_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size"), F.lit("a").alias("actor"))
    return claims.reify(p, "p_partkey", ["brand", "size"], "actor")


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events in order: each supersedes the one before it."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = load(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("verdict_id"), F.col("user_id").alias("claim_id"), F.when(F.col("event_type") == "error", "rejected").otherwise("approved").alias("outcome"), F.lag("event_id").over(w).alias("supersedes"))


@book.query("""
SELECT event_id AS verdict_id, user_id AS claim_id, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'approved' END AS outcome FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def verdict_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims.tips(_verdicts(spark, sf_dir)).select("verdict_id", "claim_id", "outcome")


@book.query("""
WITH v AS (SELECT event_id, user_id, row_number() OVER w - 1 AS n, first_value(event_id) OVER w AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id AS verdict_id, user_id AS claim_id, CASE WHEN user_id % 10 <> 3 THEN first END AS root, CASE WHEN user_id % 10 <> 3 THEN n END AS position FROM v""")
def verdict_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each verdict in its claim's chain; a tenth of the claims' chains are bent into rings, which have no first one."""
    v = _verdicts(spark, sf_dir)
    last = claims.tips(v).filter("claim_id % 10 = 3").select("claim_id", F.col("verdict_id").alias("_last"))
    bent = v.join(last, "claim_id", "left").withColumn("supersedes", F.coalesce("supersedes", "_last"))
    return claims.chains(bent)


@book.query("""
WITH tip AS (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT DISTINCT c_custkey AS subject, 'segment' AS predicate, c_mktsegment AS value FROM customer WHERE c_custkey % 10 = 0 OR c_custkey IN (SELECT user_id FROM tip WHERE event_type <> 'error')""")
def shortcut_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of claims by people, and of those whose last verdict approves."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("claim_id"), F.col("c_custkey").alias("subject"), F.lit("segment").alias("predicate"), F.col("c_mktsegment").alias("value"), F.when(F.col("c_custkey") % 10 == 0, "human").otherwise("model").alias("actor"))
    return claims.shortcuts(c, _verdicts(spark, sf_dir))


@book.query("""
WITH c AS (SELECT user_id AS subject, event_type AS predicate, CAST(event_id AS VARCHAR) AS value, event_id % 2 = 0 AS curator, ts, event_id FROM events), r AS (
  SELECT subject, predicate, arg_max(value, struct_pack(ts := ts, id := event_id)) FILTER (curator) AS chosen, min(value) AS one, count(DISTINCT value) AS n FROM c GROUP BY 1, 2)
SELECT subject, predicate, coalesce(chosen, one) AS value FROM r WHERE chosen IS NOT NULL OR n = 1""")
def display_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curator's last value, else the only one said."""
    e = load(spark, sf_dir, "events")
    c = e.select(F.col("user_id").alias("subject"), F.col("event_type").alias("predicate"), F.col("event_id").cast("string").alias("value"), F.when(F.col("event_id") % 2 == 0, "curator").otherwise("other").alias("actor"), F.struct("ts", "event_id").alias("decided_at"))
    clear = c.groupBy("subject", "predicate").agg(F.count_if(F.col("actor") == "curator").alias("k"), F.count_distinct("value").alias("n")).filter("k > 0 or n = 1")
    return claims.resolve(c.join(clear, ["subject", "predicate"], "left_semi"), "curator")


@book.query("""
SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND floor(a.s_acctbal / 100) = floor(b.s_acctbal / 100) AND a.s_suppkey <> b.s_suppkey""")
def symmetric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A relation derived from a shared value, closed under symmetry."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", F.concat_ws("/", F.col("s_nationkey").cast("string"), F.floor(F.col("s_acctbal") / 100).cast("string")).alias("v"))
    return claims.symmetric(claims.sharing(s, "s_suppkey", "v").filter("a < b"), "a", "b")
