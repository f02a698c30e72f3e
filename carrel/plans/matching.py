"""Proof queries of joins, hierarchies and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.operators import clusters, intervals, joins, trees
from carrel.plans.registry import Book
from carrel.sources.staging import fresh_dir, load, stage

book = Book()


@book.query("""
WITH spans AS (SELECT o_custkey AS cust, o_orderkey AS id, epoch(min(least(l_shipdate, o_orderdate))) // 86400 AS s, epoch(max(greatest(l_shipdate, o_orderdate))) // 86400 + 1 AS e
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT a.cust, a.id, count(b.id) AS n, coalesce(string_agg(b.id || '', ' ' ORDER BY b.id), '') AS partners
FROM spans a LEFT JOIN spans b ON a.cust = b.cust AND a.id <> b.id AND greatest(a.s, b.s) < least(a.e, b.e) GROUP BY 1, 2""")
def interval_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer that were under way at the same time."""
    days = lambda c: F.unix_date(F.to_date(c)).cast("long")
    both = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    first, last = F.min(F.least("l_shipdate", "o_orderdate")), F.max(F.greatest("l_shipdate", "o_orderdate"))
    spans = both.groupBy(F.col("o_custkey").alias("cust"), F.col("o_orderkey").alias("id")).agg(days(first).alias("start"), (days(last) + 1).alias("end"))
    found = intervals.concurrent(stage(spans, "spans"), ["cust"])
    return found.select("cust", "id", F.size("partners").cast("long").alias("n"), F.array_join(F.transform("partners", lambda x: x.cast("string")), " ").alias("partners"))


@book.query("""
SELECT c_custkey, coalesce(CASE WHEN s_suppkey % 2 = 0 THEN s_name END, c_name) AS name, coalesce(s_acctbal, c_acctbal) AS acctbal FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def precedence_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value from the first table where it is filled, else from the second."""
    c = load(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("name"), F.col("s_acctbal").alias("acctbal"))
    return joins.prefer(s, c, "c_custkey", ["name", "acctbal"])


@book.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY') END AS known FROM orders""")
def parent_in_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-valued: null without a parent, else whether it is there."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("parent"))
    return joins.reference_state(o, "parent", load(spark, sf_dir, "customer").filter("c_mktsegment = 'MACHINERY'"), "c_custkey", "known").drop("parent")


@book.query("""
WITH a AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 9 = 0 THEN p_name || '!' ELSE p_name END AS name, p_size AS size FROM part WHERE p_partkey % 11 <> 0),
b AS (SELECT p_partkey AS k, p_name AS name, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size END AS size FROM part WHERE p_partkey % 13 <> 0)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'unmatched' WHEN a.k IS NULL THEN 'missing' WHEN a.name <> b.name OR a.size IS DISTINCT FROM b.size THEN 'mismatched' ELSE 'matched' END AS status,
  CASE WHEN a.k IS NOT NULL AND b.k IS NOT NULL THEN nullif(concat_ws('|', CASE WHEN a.name <> b.name THEN 'name' END, CASE WHEN a.size IS DISTINCT FROM b.size THEN 'size' END), '') END AS fields,
  CASE WHEN a.name <> b.name THEN length(b.name) + 1 WHEN a.k IS NOT NULL AND b.k IS NOT NULL AND a.size IS DISTINCT FROM b.size THEN 1 END AS at
FROM a FULL JOIN b ON a.k = b.k""")
def full_outer_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions compared: what matches, what differs and where, what either lacks."""
    p = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    a = p.filter("k % 11 <> 0").withColumn("name", F.when(F.col("k") % 9 == 0, F.concat("name", F.lit("!"))).otherwise(F.col("name")))
    b = p.filter("k % 13 <> 0").withColumn("size", F.when(F.col("k") % 6 != 0, F.col("size")))
    return joins.compare(a, b, ["k"], ["name", "size"]).select("k", "status", F.array_join("fields", "|").alias("fields"), F.col("difference.at").cast("long").alias("at"))


@book.query("""
WITH rules AS (SELECT * FROM (VALUES (1, 'PROMO', NULL, NULL), (2, NULL, 'Brand#3', 7), (3, 'SMALL', 'Brand#4', NULL), (4, NULL, NULL, 11)) t(locator, type, brand, size))
SELECT locator, p_partkey AS key FROM rules JOIN part ON (type IS NULL OR type = p_type) AND (brand IS NULL OR brand = p_brand) AND (size IS NULL OR size = p_size)""")
def wildcard_locator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locators whose empty fields fit anything, as one equi join for each set of filled fields."""
    rules = spark.createDataFrame([(1, "PROMO", None, None), (2, None, "Brand#3", 7), (3, "SMALL", "Brand#4", None), (4, None, None, 11)], "locator int, type string, brand string, size int")
    p = load(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("type"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return joins.locate(p, "p_partkey", rules, ["type", "brand", "size"])


@book.query("""
SELECT c_custkey AS mention, n_nationkey AS nation FROM customer JOIN nation ON lower(n_name) = 'nation_' || c_nationkey""")
def alias_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions whose case and spaces differ from those of the alias."""
    m = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mention"), F.concat(F.lit("  Nation_"), F.col("c_nationkey").cast("string"), F.lit(" \n")).alias("said"))
    return joins.exact_aliases(m, "said", load(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "nation"), "n_name", "nation").select("mention", "nation")


@book.query("""
WITH a AS (SELECT DISTINCT p_brand AS id, lower(p_name) AS v FROM part), b AS (SELECT DISTINCT p_type AS id, lower(p_name) AS v FROM part)
SELECT a.id AS a_id, b.id AS b_id, count(*) AS shared FROM a JOIN b USING (v) GROUP BY 1, 2""")
def alias_set_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    sets = lambda by, change: p.groupBy(F.col(by).alias("id")).agg(F.collect_set(change("p_name")).alias("variants"))
    return joins.set_matches(sets("p_brand", F.upper), sets("p_type", F.lower))


@book.query("""
WITH n AS (SELECT min(p_partkey) AS id, p_name AS t FROM part GROUP BY p_name),
s AS (SELECT id, array_to_string(list_sort(string_split(t, ' ')), ' ') AS o, string_split(t, ' ') AS w FROM n),
m AS (SELECT id, array_to_string(list_sort(list_transform(string_split(t, ' '), lambda x: CASE WHEN x = string_split(t, ' ')[1] THEN x || 's' ELSE x END)), ' ') AS o, [x || CASE WHEN x = string_split(t, ' ')[1] THEN 's' ELSE '' END FOR x IN string_split(t, ' ')] AS w FROM n),
p AS (SELECT m.id AS mention, s.id AS name, 1 - levenshtein(m.o, s.o) / greatest(length(m.o), length(s.o), 1)::DOUBLE AS score FROM m JOIN s ON true),
b AS (SELECT * FROM p WHERE score >= 0.7 - 1e-9 QUALIFY row_number() OVER (PARTITION BY mention ORDER BY score DESC, name) = 1)
SELECT m.id AS mention, name, round(score, 6) AS score, 'pending' AS status FROM m LEFT JOIN b ON b.mention = m.id""")
def fuzzy_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The closest name of each misspelt one, for review."""
    n = load(spark, sf_dir, "part").groupBy(F.col("p_name").alias("text")).agg(F.min("p_partkey").alias("id"))
    misspelt = n.select("id", F.regexp_replace("text", r"^(\S+)", "$1s").alias("text"))
    return joins.fuzzy_queue(misspelt, n)


@book.query("""
WITH s AS (SELECT s_suppkey AS id, s_nationkey AS nation, n_regionkey AS region, CAST(floor(s_acctbal / 500) AS INT) AS band, CAST(floor(s_acctbal / 50) AS INT) AS fine FROM supplier JOIN nation ON n_nationkey = s_nationkey)
SELECT a.id AS a, b.id AS b, CASE WHEN a.nation = b.nation AND a.fine = b.fine THEN 'A' WHEN a.nation = b.nation AND a.band = b.band THEN 'B' ELSE 'C' END AS tier
FROM s a JOIN s b ON a.id < b.id AND ((a.nation = b.nation AND (a.fine = b.fine OR a.band = b.band)) OR (a.region = b.region AND a.fine = b.fine))""")
def companion_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers that belong together, in the best of three tiers."""
    s = load(spark, sf_dir, "supplier").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    items = s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("n_regionkey").alias("region"), F.floor(F.col("s_acctbal") / 500).alias("band"), F.floor(F.col("s_acctbal") / 50).alias("fine"))
    return joins.companions(items, [("A", ["nation", "fine"], None), ("B", ["nation", "band"], None), ("C", ["region", "fine"], "l_band = r_band")])


@book.query("""
SELECT o_orderkey AS mention, c_custkey AS subject FROM orders JOIN customer ON c_nationkey = o_orderkey % 25 AND c_mktsegment = 'BUILDING' AND c_custkey % 20 = o_custkey % 20""")
def narrowed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subjects that a claim allows first, by name second."""
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    number = lambda x: (F.col(x) % 20).cast("string")
    m = o.select(F.col("o_orderkey").alias("id"), F.lit("nation").alias("predicate"), (F.col("o_orderkey") % 25).cast("string").alias("value"), F.concat(F.lit("NAME "), number("o_custkey")).alias("name"))
    claims = c.select(F.col("c_custkey").alias("subject"), F.lit("nation").alias("predicate"), F.col("c_nationkey").cast("string").alias("value"))
    return joins.narrowed(m, claims, c.select(F.col("c_custkey").alias("subject"), F.concat(F.lit(" name  "), number("c_custkey")).alias("name")))


@book.query("""
WITH c AS (SELECT 'c' || c_custkey AS node, c_nationkey, n_regionkey, c_acctbal FROM customer JOIN nation ON n_nationkey = c_nationkey)
SELECT ancestor, count(*) AS n, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS cents FROM (
  SELECT node AS ancestor, c_acctbal FROM c UNION ALL SELECT 'n' || c_nationkey, c_acctbal FROM c UNION ALL SELECT 'r' || n_regionkey, c_acctbal FROM c UNION ALL SELECT 'world', c_acctbal FROM c) GROUP BY 1""")
def hierarchy_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers counted at their nation, region and the world, over the closure of the tree."""
    c, n, r = (load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    name = lambda p, x: F.concat(F.lit(p), F.col(x).cast("string"))
    edges = c.select(name("c", "c_custkey").alias("node"), name("n", "c_nationkey").alias("parent")).unionByName(n.select(name("n", "n_nationkey").alias("node"), name("r", "n_regionkey").alias("parent")))
    edges = edges.unionByName(r.select(name("r", "r_regionkey").alias("node"), F.lit("world").alias("parent"))).unionByName(spark.createDataFrame([("world", None)], "node string, parent string"))
    reach = trees.closure(edges, "node", "parent", lambda df, i: stage(df, f"reach-{i}"))
    items = c.select(name("c", "c_custkey").alias("at"), F.round(F.col("c_acctbal") * 100).cast("long").alias("cents"))
    return trees.rolled_up(items, "at", reach, "cents").withColumnRenamed("total", "cents")


@book.query("SELECT doc_id AS id, min(doc_id) OVER (PARTITION BY text) AS cluster FROM documents")
def clusters_min_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of equal texts, each linked to the one before it, followed to their first document."""
    d = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.sha2("text", 256).alias("h"))
    before = F.lag("id").over(Window.partitionBy("h").orderBy("id"))
    links = d.select(F.col("id").alias("a"), before.alias("b")).filter("b is not null")
    return clusters.min_label(d.select("id"), links, lambda df, i: stage(df, f"labels-{i}"))


@book.query("""
WITH x AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS c, source AS g FROM documents), cells AS (SELECT c, g, count(*) AS n FROM x GROUP BY 1, 2),
own AS (SELECT c, sum(n) AS nc FROM cells GROUP BY 1), gold AS (SELECT g, sum(n) AS ng FROM cells GROUP BY 1)
SELECT round(sum(n * n / nc) / sum(n), 9) AS precision, round(sum(n * n / ng) / sum(n), 9) AS recall FROM cells JOIN own USING (c) JOIN gold USING (g)""")
def bcubed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well groups of equal texts agree with sources."""
    d = load(spark, sf_dir, "documents")
    found = clusters.by_equal(d, "doc_id", "text")
    return clusters.b_cubed(found, d.select(F.col("doc_id").alias("id"), F.col("source").alias("cluster"))).select(F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@book.query("""
WITH x AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS c, lang AS g FROM documents),
j AS (SELECT sum(n * (n - 1) / 2) AS p FROM (SELECT count(*) AS n FROM x GROUP BY c, g)), o AS (SELECT sum(n * (n - 1) / 2) AS p FROM (SELECT count(*) AS n FROM x GROUP BY c)), t AS (SELECT sum(n * (n - 1) / 2) AS p FROM (SELECT count(*) AS n FROM x GROUP BY g))
SELECT round(j.p / o.p, 9) AS precision, round(j.p / t.p, 9) AS recall FROM j, o, t""")
def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall over pairs, counted by cell sizes."""
    d = load(spark, sf_dir, "documents")
    found = clusters.by_equal(d, "doc_id", "text")
    return clusters.pair_scores(found, d.select(F.col("doc_id").alias("id"), F.col("lang").alias("cluster"))).select(F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@book.query("""
SELECT outcome, count(*) AS n FROM (
  SELECT CASE WHEN a.s_nationkey <> b.s_nationkey THEN 'nation' WHEN abs(a.s_acctbal - b.s_acctbal) > 5000 THEN 'balance' ELSE 'link' END AS outcome
  FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1) GROUP BY 1""")
def cannot_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with the first constraint that forbids their link."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    pairs = s.join(s.select((F.col("s_suppkey") - 1).alias("s_suppkey"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")), "s_suppkey")
    return clusters.escalate(pairs, [("nation", "s_nationkey <> nation"), ("balance", "abs(s_acctbal - balance) > 5000")]).groupBy("outcome").agg(F.count("*").alias("n"))


@book.query("""
WITH c AS (SELECT c_custkey AS id, c_custkey // 3 AS g, c_custkey % 3 AS i, c_mktsegment AS s, c_nationkey AS n, c_acctbal * 1000000 + c_custkey AS w FROM customer),
t AS (SELECT g, max(id) FILTER (i = 0) AS x, max(id) FILTER (i = 1) AS y, max(id) FILTER (i = 2) AS z, max(w) FILTER (i = 0) > max(w) FILTER (i = 2) AS xy_first,
        max(s) FILTER (i = 0) = max(s) FILTER (i = 1) AS f_xy, max(s) FILTER (i = 1) = max(s) FILTER (i = 2) AS f_yz, max(s) FILTER (i = 0) = max(s) FILTER (i = 2) OR max(n) FILTER (i = 0) <> max(n) FILTER (i = 2) AS f_xz FROM c GROUP BY g),
u AS (SELECT *, CASE WHEN xy_first OR z IS NULL THEN NOT f_xy WHEN NOT f_yz THEN NOT (f_xy OR f_xz) ELSE NOT f_xy END AS xy,
        CASE WHEN NOT xy_first THEN NOT f_yz WHEN NOT f_xy THEN NOT (f_yz OR f_xz) ELSE NOT f_yz END AS yz FROM t)
SELECT id, CASE i WHEN 0 THEN x WHEN 1 THEN CASE WHEN xy THEN x ELSE y END ELSE CASE WHEN yz AND xy THEN x WHEN yz THEN y ELSE z END END AS cluster FROM c JOIN u USING (g)""")
def constrained_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chains of three customers: none may hold two of one segment, and their ends must be of one nation."""
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 3).alias("i"), "c_mktsegment", "c_nationkey", (F.col("c_acctbal") * 1000000 + F.col("c_custkey")).alias("w"))
    links = c.filter("i = 0").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.col("w").alias("weight")).unionByName(c.filter("i = 2").select((F.col("id") - 1).alias("a"), F.col("id").alias("b"), F.col("w").alias("weight")))
    ends = c.filter("i = 2").select((F.col("id") - 2).alias("a"), F.col("id").alias("b"), F.col("c_nationkey").alias("_n"))
    cannot = c.filter("i = 0").join(ends, F.col("id") == F.col("a")).filter("c_nationkey <> _n").select("a", "b")
    return clusters.constrained(c, links, cannot, c.select("id", F.col("c_mktsegment").alias("key")))[0]


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of the world, its regions, nations and customers, numbered."""
    c, n, r = (load(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    name = lambda p, x: F.concat(F.lit(p), F.col(x).cast("string"))
    edges = c.select(name("c", "c_custkey").alias("node"), name("n", "c_nationkey").alias("parent")).unionByName(n.select(name("n", "n_nationkey").alias("node"), name("r", "n_regionkey").alias("parent")))
    edges = edges.unionByName(r.select(name("r", "r_regionkey").alias("node"), F.lit("world").alias("parent"))).unionByName(spark.createDataFrame([("world", None)], "node string, parent string"))
    return stage(trees.numbered(edges, "node", "parent", trees.closure(edges, "node", "parent", lambda df, i: stage(df, f"reach-{i}"))), "tree")


def _tiers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = load(spark, sf_dir, "orders")
    start = F.unix_date(F.to_date("o_orderdate"))
    items = o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws("/", "o_custkey", "o_orderpriority")).alias("set_id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("node"), start.alias("start"), (start + 90).alias("end"), F.col("o_orderstatus").alias("type"))
    related = spark.createDataFrame([("F", "old"), ("P", "new"), ("O", "new")], "type string, family string")
    return joins.tiers_by_place(items, _places(spark, sf_dir), related, 2)


@book.query("""
WITH o AS (SELECT o_orderkey AS id, o_custkey AS c, o_orderpriority AS p, epoch(CAST(o_orderdate AS DATE)) // 86400 AS s, o_orderstatus = 'F' AS old FROM orders)
SELECT a.id AS a, b.id AS b, CASE WHEN a.id % 2 = 0 AND b.id % 2 = 0 AND a.p = b.p THEN 'A' ELSE 'B' END AS tier FROM o a JOIN o b ON a.c = b.c AND a.id < b.id
WHERE (a.id % 2 = 0 AND b.id % 2 = 0 AND a.p = b.p) OR (a.old = b.old AND abs(a.s - b.s) < 90)""")
def tiers_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one set, or of one customer with overlapping times and related states."""
    return _tiers(spark, sf_dir)[0]


@book.query("""
SELECT o_orderkey AS id, 'n' || c_nationkey AS region, count(*) OVER (PARTITION BY c_nationkey) AS n FROM orders JOIN customer ON c_custkey = o_custkey""")
def region_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as members of their nation, found by ranges of the numbered tree."""
    return _tiers(spark, sf_dir)[1]


@book.query("""
SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'c' || c_custkey WHEN 1 THEN 'n' || c_nationkey ELSE 'r' || n_regionkey END AS node
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def broadest_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vague records, which may mean a customer, its nation or its region, at the broadest of what they may mean."""
    c = load(spark, sf_dir, "customer").join(load(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    o = load(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"))
    named = [F.concat(F.lit(p), F.col(x).cast("string")) for p, x in (("c", "c_custkey"), ("n", "c_nationkey"), ("r", "n_regionkey"))]
    may = o.select(F.col("o_orderkey").alias("id"), F.explode(F.slice(F.array(*named), F.lit(1), F.col("o_orderkey") % 3 + 1)).alias("node"))
    return trees.broadest(may, _places(spark, sf_dir))


@book.query("""
SELECT user_id AS mention, arg_max(event_type, struct_pack(a := floor(epoch(ts)), b := event_id % 3, s := event_type)) AS status, CAST(max(floor(epoch(ts))) AS BIGINT) AS "at", count(*) AS events FROM events GROUP BY 1""")
def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review log of three batches, of which one was written twice, folded to the state of each mention."""
    e = load(spark, sf_dir, "events").select(F.col("user_id").alias("mention"), F.col("event_type").alias("status"), F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), "event_id")
    path = fresh_dir(spark, "review")
    for part in (0, 1, 2, 1):
        joins.record_verdicts(e.filter(F.col("event_id") % 3 == part), path, f"b{part}")
    return joins.folded(spark, path)
