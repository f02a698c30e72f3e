"""Proof queries of corrections, derivations and years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions import names, text, years
from carrel.operators import patching
from carrel.plans.registry import Book
from carrel.sources import sinks
from carrel.sources.staging import load

book = Book()


@book.query("""
SELECT p_partkey, CASE WHEN p_partkey % 50 = 0 THEN 'patched' ELSE p_name END AS p_name, CASE WHEN p_partkey % 100 = 0 THEN NULL WHEN p_partkey % 50 = 0 THEN 7 ELSE p_size END AS p_size FROM part""")
def patch_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches in order, the last of a cell winning; one to null sets null."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    some = p.filter("p_partkey % 50 = 0").select(F.col("p_partkey").alias("key"))
    patch = lambda df, field, value, at: df.select("key", F.lit(field).alias("field"), F.lit(value).cast("string").alias("value"), F.lit(at).alias("at"))
    patches = patch(some, "p_name", "first", 1).unionByName(patch(some, "p_name", "patched", 2)).unionByName(patch(some, "p_size", "7", 1)).unionByName(patch(some.filter("key % 100 = 0"), "p_size", None, 2))
    return patching.patch_cells(p, "p_partkey", patches, "at")


@book.query("""
SELECT 'shrink' AS stage, p_partkey, 'p_size' AS field, CAST(p_size AS VARCHAR) AS before, '1' AS after FROM part WHERE p_size % 10 = 0
UNION ALL SELECT 'shrink', p_partkey, 'p_name', p_name, NULL FROM part WHERE p_size % 20 = 0""")
def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    after = p.withColumns({"p_name": F.when(F.col("p_size") % 20 != 0, F.col("p_name")), "p_size": F.when(F.col("p_size") % 10 == 0, 1).otherwise(F.col("p_size"))})
    return sinks.audit(p, after, ["p_partkey"], ["p_name", "p_size"], "shrink")


@book.query("""
SELECT CASE WHEN n_nationkey < 5 THEN 'LAND_' || n_nationkey ELSE n_name END AS n_name, n_nationkey AS number, 'none' AS polity FROM nation""")
def rename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and a column renamed, a missing column filled with its default."""
    n = load(spark, sf_dir, "nation").select("n_name", "n_nationkey")
    renames = n.filter("n_nationkey < 5").select(F.col("n_name").alias("old"), F.concat(F.lit("LAND_"), F.col("n_nationkey").cast("string")).alias("new"))
    out = patching.rename_column(patching.rename_keys(n, "n_name", renames), "n_nationkey", "number")
    return patching.backfill(out, {"polity": F.lit("none"), "number": F.lit(0)})


@book.query("""
SELECT p_type AS old, CASE p_type WHEN 'LARGE' THEN 'BIG' ELSE 'TINY' END AS new, count(*) AS n, min(p_partkey) AS first_key, max(p_partkey) AS last_key FROM part WHERE p_type IN ('LARGE', 'SMALL') GROUP BY 1""")
def migrated_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patching.migrated(load(spark, sf_dir, "part"), "p_type", "p_partkey", {"LARGE": "BIG", "SMALL": "TINY"})


@book.query("""
SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS urgent FROM customer""")
def flag_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select("c_custkey", F.lit(False).alias("urgent"))
    return patching.flag_members(c, "c_custkey", load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select("o_custkey"), "urgent")


@book.query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 1000000 ELSE s_suppkey END AS id, CASE WHEN s_suppkey % 3 = 0 THEN 'right' ELSE s_name END AS name FROM supplier""")
def apply_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Right ids within their chunk: those given for another chunk do nothing."""
    s = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, "x").otherwise("y").alias("chunk"), F.lit("a").alias("agent"))
    fix = s.select(F.lit("x").alias("chunk"), "agent", F.col("id").alias("wrong"), (F.col("id") + 1000000).alias("right"), F.lit("right").alias("right_name"))
    return patching.apply_corrections(s, fix, "id", "name").select("s_suppkey", "id", "name")


@book.query("""
SELECT p_partkey, p_name AS name, p_size % 2 = 0 AS syllabic, CASE WHEN p_size % 12 > 0 THEN p_size % 12 END AS ordinal, CASE WHEN p_type = p_brand THEN p_type ELSE least(p_type, p_brand) || '|' || greatest(p_type, p_brand) END AS variants FROM part""")
def strip_promote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks at the end of names become columns: an ordinal, syllabic writing in any case, and variants."""
    roman = F.element_at(F.array(F.lit(""), *(F.lit(f" ({r})") for r in list(names.ROMAN)[:11])), F.col("p_size") % 12 + 1)
    mark = F.when(F.col("p_size") % 2 == 0, " (Syllabic)").otherwise("")
    made = F.concat("p_name", roman, mark, F.lit(", var. "), "p_type", F.lit(", var. "), "p_brand")
    r = names.without_marks(made)
    return load(spark, sf_dir, "part").select("p_partkey", r["name"].alias("name"), r["syllabic"].alias("syllabic"), r["ordinal"].alias("ordinal"), F.array_join(r["variants"], "|").alias("variants"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN '(' || p_name || ')' ELSE p_name || ' ' || p_type END AS name, CASE WHEN p_size % 5 = 0 THEN '' ELSE p_brand || '|' || p_type || '|x' END AS variants FROM part""")
def paren_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("("), "p_name", F.lit(")"))).otherwise(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(", "), "p_type", F.lit(") "), "p_type", F.lit(" (x) (?)")))
    r = names.parenthesis_variants(made)
    return load(spark, sf_dir, "part").select("p_partkey", r["name"].alias("name"), F.array_join(r["variants"], "|").alias("variants"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN '1=' || p_name ELSE '1=' || p_name || '|2=' || p_type || '; ' || p_brand || '|12=end' END AS entries,
  'PM 4' || p_size || '|PM 7|Baud x' AS refs FROM part""")
def enumeration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.when(F.col("p_size") % 4 == 0, F.col("p_name")).otherwise(F.concat(F.lit("1: "), "p_name", F.lit("; 2: "), "p_type", F.lit("; "), "p_brand", F.lit("; 12: end")))
    shown = F.array_join(F.transform(names.enumeration(made), lambda x: F.concat(x["number"].cast("string"), F.lit("="), x["text"])), "|")
    refs = F.array_join(names.references(F.concat(F.lit("PM 4"), F.col("p_size").cast("string"), F.lit(" et 7; Baud x"))), "|")
    return load(spark, sf_dir, "part").select("p_partkey", shown.alias("entries"), refs.alias("refs"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'uncertain' WHEN p_type = 'PROMO' THEN 'probable' ELSE 'attested' END AS certainty,
  replace(replace(p_name, 'red', 'blue'), 'blue', 'green') AS replaced, CASE WHEN p_size % 3 = 0 THEN p_type ELSE 'at ' || p_type END AS locality FROM part""")
def hedge_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived columns: the strongest hedge, ordered replacements, the last place unless known."""
    made = F.concat("p_name", F.when(F.col("p_size") % 2 == 0, " possibly").otherwise(""), F.when(F.col("p_type") == "PROMO", " probably").otherwise(""))
    place = F.concat(F.lit("from Giza; from "), "p_type")
    default = F.when(F.col("p_size") % 3 == 0, "Giza").otherwise(F.concat(F.lit("at "), "p_type"))
    derivers = [("certainty", text.first_label(made, [("uncertain", "possibly"), ("probable", "probably")], "attested")), ("replaced", text.replaced("p_name", [("red", "blue"), ("blue", "green")])), ("locality", names.last_locality(place, r"from (\w+)", default))]
    return patching.derive(load(spark, sf_dir, "part"), derivers).select("p_partkey", "certainty", "replaced", "locality")


@book.query("""
SELECT doc_id, CASE WHEN d.doc_id IS NOT NULL AND l.quality IS NOT NULL THEN 'both' WHEN d.doc_id IS NOT NULL THEN 'start_only' WHEN l.quality IS NOT NULL THEN 'end_only' ELSE 'none' END AS attested
FROM documents d FULL JOIN labels l USING (doc_id)""")
def null_pattern_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").select("doc_id", "n_chars")
    both = d.join(load(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "full_outer")
    return both.select("doc_id", years.attested("n_chars", "quality").alias("attested"))


@book.query("""
SELECT event_id, CASE k WHEN 0 THEN -(b + a) WHEN 1 THEN b WHEN 2 THEN -b WHEN 3 THEN NULL WHEN 4 THEN -b ELSE b END AS start,
  CASE k WHEN 0 THEN -b WHEN 1 THEN b + a WHEN 2 THEN a WHEN 3 THEN -b WHEN 4 THEN NULL ELSE NULL END AS "end"
FROM (SELECT event_id, event_id % 6 AS k, event_id % 37 + 1 AS a, event_id % 1000 + 10 AS b FROM events)""")
def reign_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Falling, rising, marked, open and single years, before and in the common era."""
    e = load(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 6).alias("k"), (F.col("event_id") % 37 + 1).cast("string").alias("a"), (F.col("event_id") % 1000 + 10).cast("string").alias("b"))
    sum_ = (F.col("a").cast("int") + F.col("b").cast("int")).cast("string")
    made = F.when(F.col("k") == 0, F.concat(sum_, F.lit("–"), "b")).when(F.col("k") == 1, F.concat("b", F.lit("-"), sum_)).when(F.col("k") == 2, F.concat("b", F.lit(" BC–"), "a", F.lit(" CE"))).when(F.col("k") == 3, F.concat(F.lit("?–"), "b")).otherwise(F.col("b"))
    r = years.reign(made, F.col("k") == 5)
    return e.select("event_id", r["start"].cast("long").alias("start"), r["end"].cast("long").alias("end"))


@book.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN a < 0 THEN a + 1 ELSE a END AS older, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN b < 0 THEN b + 1 ELSE b END AS younger,
  CASE WHEN o_orderkey % 7 = 0 THEN 'unknown' WHEN o_orderkey % 5 = 0 THEN 'approximate' WHEN a = b THEN 'exact' ELSE 'range' END AS precision, CASE WHEN o_orderkey % 7 = 0 THEN 'no_date' END AS null_reason
FROM (SELECT o_orderkey, CAST(o_orderkey % 900 - 500 - (o_orderkey % 900 >= 500)::INT * -1 AS BIGINT) AS a, CAST(o_orderkey % 900 - 500 - (o_orderkey % 900 >= 500)::INT * -1 + CASE WHEN o_orderkey % 900 - 500 < -40 THEN o_orderkey % 3 ELSE 0 END AS BIGINT) AS b FROM orders)""")
def date_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bounds in astronomical years, given in either order; there is no year 0 to start from."""
    raw = F.col("o_orderkey") % 900 - 500
    a = F.when(raw >= 0, raw + 1).otherwise(raw)
    b = a + F.when(raw < -40, F.col("o_orderkey") % 3).otherwise(0)
    known = F.col("o_orderkey") % 7 != 0
    e = years.envelope(F.when(known, b), F.when(known, a), F.col("o_orderkey") % 5 == 0)
    return load(spark, sf_dir, "orders").select("o_orderkey", e["older"].alias("older"), e["younger"].alias("younger"), e["precision"].alias("precision"), e["null_reason"].alias("null_reason"))


@book.query("""
SELECT p_partkey, CASE k WHEN 1 THEN s || '|' || (s + 1) || '|' || (s + 2) ELSE s || '' END AS ids, CASE k WHEN 0 THEN 'late' END AS qualifier, CASE k WHEN 3 THEN 'probable' ELSE 'certain' END AS certainty,
  CASE k WHEN 1 THEN 'to' WHEN 2 THEN 'or_later' END AS relation FROM (SELECT p_partkey, p_partkey % 4 AS k, p_size AS s FROM part)""")
def dating_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    made = F.when(k == 0, F.concat(F.lit("late Dynasty "), s)).when(k == 1, F.concat(F.lit("Dynasty "), s, F.lit("–"), (F.col("p_size") + 2).cast("string"))).when(k == 2, F.concat(F.lit("Dynasty "), s, F.lit(", or later"))).otherwise(F.concat(F.lit("Dynasty "), s, F.lit(" (probably)")))
    r = years.dating(made)
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(r["ids"], lambda x: x.cast("string")), "|").alias("ids"), r["qualifier"].alias("qualifier"), r["certainty"].alias("certainty"), r["relation"].alias("relation"))
