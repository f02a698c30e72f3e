"""Proof queries of validation, profiles, orders and the streaming extension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.operators import guards, ordering, profile
from carrel.plans.registry import Book
from carrel.sources import snapshots
from carrel.sources.staging import fresh_dir, load
from carrel.streaming import latest

book = Book()


@book.query("""
SELECT 'repeated line items' AS "check", count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'unknown priorities', count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'misshapen names', count(*) FROM customer WHERE NOT regexp_matches(c_name, '^Customer#\\d{8}[0-4]$')
UNION ALL SELECT 'orphaned events', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)
UNION ALL SELECT 'sizes out of range', count(*) FROM part WHERE p_size NOT BETWEEN 5 AND 40
UNION ALL SELECT 'flag without status', count(*) FROM lineitem WHERE (l_returnflag = 'R') <> (l_linestatus = 'F')
UNION ALL SELECT 'points outside', count(*) FROM supplier WHERE NOT (s_nationkey BETWEEN 0 AND 20 AND s_acctbal BETWEEN 0 AND 5000)""")
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of keys, vocabularies, shapes, references, ranges, implications and boxes."""
    t = lambda name: load(spark, sf_dir, name)
    li = t("lineitem")
    return guards.violations({
        "repeated line items": guards.repeated_keys(li, ["l_orderkey", "l_linenumber"]),
        "unknown priorities": guards.outside_vocabulary(t("orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
        "misshapen names": guards.misshapen(t("customer"), "c_name", r"^Customer#\d{8}[0-4]$"),
        "orphaned events": guards.orphans(t("events"), "user_id", t("customer").filter("c_custkey % 2 = 0"), "c_custkey"),
        "sizes out of range": guards.outside(t("part"), "p_size", 5, 40),
        "flag without status": guards.disagreeing(li, F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"),
        "points outside": guards.outside_box(t("supplier"), "s_nationkey", "s_acctbal", (0, 0, 20, 5000)),
    })


@book.query("""
SELECT 'lang' AS field, count(lang) FILTER (lang <> '') AS filled, count(*) AS total, CAST(floor(100 * count(lang) FILTER (lang <> '') / count(*)) AS BIGINT) AS percent FROM documents d LEFT JOIN labels USING (doc_id)
UNION ALL SELECT 'quality', count(quality), count(*), CAST(floor(100 * count(quality) / count(*)) AS BIGINT) FROM documents d LEFT JOIN labels USING (doc_id)""")
def fill_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return profile.fill_rates(d, ["lang", "quality"])


@book.query("SELECT user_id, count(DISTINCT event_type) AS sections FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def multi_section_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guards.in_several_sections(load(spark, sf_dir, "events"), "user_id", "event_type")


@book.query("SELECT p_name AS value, count(*) AS n FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_type = 'PROMO' AND p_size < 5) GROUP BY 1")
def unmatched_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return profile.unmatched(p, "p_name", p.filter("p_type = 'PROMO' and p_size < 5"), "p_name")


@book.query("SELECT doc_id, sha256('{\"lang\":\"' || lang || '\",\"n_chars\":' || n_chars || '}') AS digest FROM documents")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("doc_id", profile.content_hash("lang", "n_chars").alias("digest"))


@book.query("SELECT n_name AS site, c_mktsegment AS museum, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2")
def map_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return c.groupBy(F.col("n_name").alias("site"), F.col("c_mktsegment").alias("museum")).agg(F.count("*").alias("n"))


@book.query("""
SELECT n_name, row_number() OVER (ORDER BY n_nationkey % 3 = 0, n_nationkey) AS place, row_number() OVER (ORDER BY CASE n_regionkey WHEN 3 THEN 0 WHEN 1 THEN 1 ELSE 9999 END, n_nationkey) AS by_region FROM nation""")
def composite_sort_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in natural order: NATION_10 after NATION_9, unplaced ones last, regions by a list."""
    n = load(spark, sf_dir, "nation")
    last = (F.col("n_nationkey") % 3 == 0).cast("int")
    number = ordering.parsed("n_name", r"^NATION_(\d+)$", [True])
    region = ordering.ranked(F.col("n_regionkey").cast("string"), ["3", "1"])
    by_place = ordering.placed(n, [last, ordering.natural("n_name")])
    return ordering.placed(by_place, [region, *number], "by_region").select("n_name", "place", "by_region")


@book.query("""
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus = 'F', o_custkey % 4 = 0, lower(o_orderpriority), o_totalprice DESC, o_orderkey) AS place FROM orders""")
def orders_in_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places over the whole table: unplaced orders last, damaged names after whole ones, then by name, price and key."""
    name = F.when(F.col("o_custkey") % 4 == 0, F.concat(F.lit(" ["), "o_orderpriority")).otherwise(F.col("o_orderpriority"))
    bins = ordering.binned("_name", F.col("o_orderstatus") == "F")
    o = load(spark, sf_dir, "orders").withColumn("_name", name)
    return ordering.placed(o, [*bins, F.col("o_totalprice") * -1, "o_orderkey"]).select("o_orderkey", "place")


@book.query("SELECT side, count(*) AS n FROM (SELECT 'left' AS side FROM part WHERE p_size % 5 = 0 UNION ALL SELECT 'right' FROM part WHERE p_size % 5 = 0) GROUP BY 1")
def table_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two versions of a table that the other lacks."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    changed = p.withColumn("p_name", F.when(F.col("p_size") % 5 == 0, F.concat("p_name", F.lit("'"))).otherwise(F.col("p_name")))
    return guards.differing(p, changed).groupBy("side").agg(F.count("*").alias("n"))


@book.query("SELECT DISTINCT unnest(json_keys(props)) AS name FROM events")
def field_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.field_names(load(spark, sf_dir, "events"), "props")


@book.query("""
SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM events
WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extension: hourly counts of an event stream, windows closed by the watermark."""
    schema = load(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    out, state = fresh_dir(spark, "windows"), fresh_dir(spark, "windows-state")
    counted = latest.windowed_counts(stream, "ts", "event_type")
    counted.writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    return spark.read.schema(counted.schema).parquet(out).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "n")


@book.query("""
SELECT p_partkey, p_name, CASE WHEN p_partkey % 100 = 7 THEN p_size + 1 ELSE p_size END AS p_size FROM part
UNION ALL SELECT p_partkey + 1000000000, p_name, p_size FROM part WHERE p_partkey % 100 = 9""")
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table after an upsert of some changed and some new keys."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    path = fresh_dir(spark, "stored")
    snapshots.create(p, path, ["p_partkey"], buckets=32)
    changed = p.filter("p_partkey % 100 = 7").withColumn("p_size", F.col("p_size") + 1)
    added = p.filter("p_partkey % 100 = 9").withColumn("p_partkey", F.col("p_partkey") + 1_000_000_000)
    return snapshots.read(spark, snapshots.upsert(changed.unionByName(added), path))


@book.query("""
SELECT p_partkey + 1000000000 AS p_partkey, 'added' AS change FROM part WHERE p_partkey % 50 = 5
UNION ALL SELECT p_partkey, CASE p_partkey % 50 WHEN 3 THEN 'removed' ELSE 'changed' END FROM part WHERE p_partkey % 50 IN (3, 4)""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that were added, removed or changed between two snapshots, by their hash trees."""
    p = load(spark, sf_dir, "part")
    key = F.col("p_partkey")
    later = p.filter(key % 50 != 3).withColumn("p_name", F.when(key % 50 == 4, F.concat("p_name", F.lit("'"))).otherwise(F.col("p_name")))
    later = later.unionByName(p.filter(key % 50 == 5).withColumn("p_partkey", key + 1_000_000_000))
    old, new = fresh_dir(spark, "snapshot"), fresh_dir(spark, "snapshot")
    for rows, path in ((p, old), (later, new)):
        snapshots.snapshot(rows, path, ["p_partkey"])
    return snapshots.changes(spark, old, new)
