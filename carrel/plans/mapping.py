"""Proof queries of record mapping, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions import text
from carrel.operators import profile, search
from carrel.plans.registry import Book
from carrel.sources import landed, places, records, sinks
from carrel.sources.staging import load

book = Book()


@book.query("SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_project_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select("event_id", "event_type", F.from_json("props", "k int", {"mode": "FAILFAST"})["k"].alias("k"))


@book.query("""
SELECT o_orderkey, 'status' AS field, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS value FROM orders
UNION ALL SELECT o_orderkey, 'priority', CASE WHEN o_orderkey % 3 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END FROM orders""")
def json_overlay_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details cover every third order; every sixth has an explicit null, which replaces the status."""
    o = load(spark, sf_dir, "orders")
    base = o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))).alias("data"))
    low = F.struct(F.lower("o_orderpriority").alias("priority"))
    nulled = F.struct(F.lit(None).cast("string").alias("status"), F.lower("o_orderpriority").alias("priority"))
    data = F.when(F.col("o_orderkey") % 6 == 0, F.to_json(nulled, {"ignoreNullFields": "false"})).otherwise(F.to_json(low))
    detail = o.filter("o_orderkey % 3 = 0").select("o_orderkey", data.alias("data"))
    return records.overlay(base, detail, "o_orderkey", ["status", "priority"])


@book.query(r"""
SELECT doc_id, array_to_string(parts, '|') AS parts, len(parts) AS n FROM (
  SELECT doc_id, [regexp_replace(x, '^\s+|\s+$', '', 'g') FOR x IN string_split_regex(text, '[,;.]+') IF regexp_replace(x, '^\s+|\s+$', '', 'g') <> ''] AS parts FROM documents)
WHERE len(parts) > 0""")
def split_clean_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", text.split_clean("text", "[,;.]+").alias("p")).filter("p is not null").select("doc_id", F.array_join("p", "|").alias("parts"), F.size("p").cast("long").alias("n"))


@book.query("""
SELECT n_nationkey, nullif(concat_ws(', ', nullif(r_name, ''), nullif(CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE n_name END, ''), CASE WHEN n_nationkey % 3 = 0 THEN 'third' END), '') AS place
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def concat_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    some = F.when(F.col("n_nationkey") % 2 == 0, "").otherwise(F.col("n_name"))
    return n.select("n_nationkey", text.joined(", ", "r_name", some, F.when(F.col("n_nationkey") % 3 == 0, "third")).alias("place"))


@book.query("""
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' ELSE lower(o_orderpriority) END AS open_code,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partly' END AS closed_code FROM orders""")
def codemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        text.open_code("o_orderpriority", {"1-URGENT": "now", "2-HIGH": "soon"}).alias("open_code"),
        text.closed_code("o_orderstatus", {"F": "done", "O": "open", "P": "partly"}, "status").alias("closed_code"),
    )


@book.query("""
SELECT page_id, nullif(regexp_extract(url, '://([^/]+)', 1), '') AS host, nullif(regexp_extract(url, '(\\d+)', 1), '') AS number,
  CASE WHEN url LIKE '%/%' THEN 'https://thumbs.example/' || nullif(list_extract(string_split(url, '/'), -1), '') || '?width=400' END AS thumbnail FROM pages""")
def url_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "pages")
    return p.select("page_id", text.found("url", "://([^/]+)").alias("host"), text.found("url", r"(\d+)").alias("number"), records.thumbnail("url", "https://thumbs.example/", "?width=400").alias("thumbnail"))


@book.query("""
SELECT doc_id, license, CASE WHEN license = 'none' THEN 'placeholder' WHEN license = 'restricted' THEN 'link' ELSE 'embed' END AS mode, license = 'cc-by' AS attribution
FROM (SELECT d.doc_id, CASE WHEN d.n_chars % 5 = 0 THEN 'none' WHEN l.quality = 1 THEN CASE WHEN d.lang = 'en' THEN 'cc0' ELSE 'cc-by' END ELSE 'restricted' END AS license
      FROM documents d LEFT JOIN labels l USING (doc_id))""")
def license_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id", "left")
    image = F.when(F.col("n_chars") % 5 != 0, F.concat(F.lit("https://images.example/"), F.col("doc_id").cast("string")))
    free = F.col("quality") == 1
    lic = F.when(F.col("lang") == "en", records.license_of(image, free, "cc0")).otherwise(records.license_of(image, free, "cc-by"))
    shown = search.render(lic, image, F.lit(None).cast("string"))
    return d.select("doc_id", lic.alias("license"), shown["mode"].alias("mode"), shown["attribution"].alias("attribution"))


@book.query("""
SELECT conv_id FROM conversations GROUP BY conv_id
HAVING count(*) FILTER (role = 'assistant') = 0 OR bool_or(role = 'assistant' AND turn IN (3, 5))""")
def array_exists_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule for cultures on turns: no assistant at all, or one at a turn of the list."""
    c = load(spark, sf_dir, "conversations")
    role = F.when(F.col("role") == "assistant", "Culture").otherwise(F.col("role"))
    grouped = c.groupBy("conv_id").agg(F.collect_set(F.struct(role.alias("role"), F.col("turn").cast("string").alias("name"))).alias("constituents"))
    return grouped.filter(records.in_collection("constituents", ["3", "5"])).select("conv_id")


@book.query(r"""
SELECT 'met-' || p_partkey AS id, array_to_string([trim(x) FOR x IN string_split(p_name, ' ') IF trim(x) <> ''], '|') AS materials, CASE WHEN p_size % 2 = 0 THEN p_type END AS ruler,
  -p_size AS date_start, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS date_end, p_brand || ', ' || p_type AS origin_site_raw,
  CASE WHEN p_size % 4 = 0 THEN 'confirmed' ELSE lower(p_type) END AS origin_certainty, 'Gallery ' || p_size AS current_location,
  CASE WHEN p_size % 5 = 0 THEN 'none' WHEN p_size % 2 = 0 THEN 'cc0' ELSE 'restricted' END AS license, 'Q' || p_partkey AS wikidata_id FROM part""")
def map_met(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("p_size") % 2 == 0
    raw = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("p_partkey").alias("objectID"), F.lit("https://x.example/1").alias("objectURL"), F.replace("p_name", F.lit(" "), F.lit(",\r\n")).alias("medium"),
            F.when(even, F.concat(F.lit("Joint reign of "), "p_type")).otherwise("").alias("reign"), F.negate("p_size").alias("objectBeginDate"),
            F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_size").cast("string")).alias("objectEndDate"), F.col("p_brand").alias("country"), F.lit("").alias("region"), F.col("p_type").alias("locus"),
            F.when(F.col("p_size") % 4 == 0, "From").otherwise(F.col("p_type")).alias("geographyType"), F.col("p_size").cast("string").alias("GalleryNumber"),
            F.when(F.col("p_size") % 5 != 0, "https://x.example/i.jpg").alias("primaryImage"), even.alias("isPublicDomain"), F.concat(F.lit("https://w.example/Q"), F.col("p_partkey").cast("string")).alias("objectWikidata_URL"),
        )).alias("data"),
    )
    return records.met(raw).select("id", F.array_join("materials", "|").alias("materials"), F.col("ruler_display_name").alias("ruler"), "date_start", "date_end", "origin_site_raw", "origin_certainty", "current_location", "license", "wikidata_id")


@book.query("""
SELECT 'harvard-' || p_partkey AS id, p_type AS period, CASE WHEN p_size % 2 = 0 THEN 'Dynasty ' || p_size END AS dynasty, p_name AS object_type, nullif(p_size % 7, 0) AS date_start,
  CASE WHEN p_size % 3 = 0 THEN p_brand END AS origin_site_raw, CASE WHEN p_size % 5 = 0 THEN 'https://x.example/t?width=400' END AS thumbnail_url,
  CASE WHEN p_size % 5 = 0 THEN 'non-commercial-educational' ELSE 'restricted' END AS license FROM part""")
def map_harvard(spark: SparkSession, sf_dir: str) -> DataFrame:
    period = F.when(F.col("p_size") % 2 == 0, F.concat("p_type", F.lit(", Dynasty "), F.col("p_size").cast("string"))).otherwise(F.col("p_type"))
    kind = F.when(F.col("p_size") % 3 == 0, "Creation Place").otherwise("Other")
    raw = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("p_partkey").alias("id"), period.alias("period"), F.array(F.struct(F.col("p_name").alias("worktype"))).alias("worktypes"), (F.col("p_size") % 7).alias("datebegin"),
            F.array(F.struct(F.lit("nowhere").alias("displayname"), F.lit("Exhibition").alias("type")), F.struct(F.col("p_brand").alias("displayname"), kind.alias("type"))).alias("places"),
            (F.col("p_size") % 5).alias("imagepermissionlevel"), F.lit("https://x.example/i").alias("primaryimageurl"), F.array(F.struct(F.lit("https://x.example/t").alias("baseimageurl"))).alias("images"),
        )).alias("data"),
    )
    return records.harvard(raw).select("id", "period", "dynasty", "object_type", "date_start", "origin_site_raw", "thumbnail_url", "license")


@book.query("""
SELECT 'brooklyn-' || p_partkey AS id, p_name || ' cm' AS dimensions, p_size AS date_start, p_brand AS origin_site_raw, CASE WHEN p_size % 2 = 0 THEN 'made_in' ELSE 'uncertain' END AS origin_certainty,
  'https://imgsrv.brooklynmuseum.org/collections/objects/' || p_partkey || '.jpg?width=400&quality=75' AS thumbnail_url, 'cc-by-nc-nd' AS license FROM part WHERE p_size % 3 <> 0""")
def map_brooklyn(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("p_size") % 2 == 0, "Place made").otherwise("Reportedly from")
    culture = F.when(F.col("p_size") % 3 == 0, "Roman").otherwise("Nubian")
    raw = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("object_id"),
        F.to_json(F.struct(
            F.col("p_partkey").cast("string").alias("sourceId"), F.concat(F.lit(" "), "p_name", F.lit(" cm\r\n")).alias("dimensions"), F.col("p_size").alias("startYear"),
            F.array(F.struct(F.lit("").alias("name"), F.lit("").alias("type")), F.struct(F.col("p_brand").alias("name"), kind.alias("type"))).alias("geographicalLocations"),
            F.array(F.struct(F.lit("Culture").alias("role"), culture.alias("name"))).alias("constituents"), F.concat(F.lit("https://c.example/o/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("imageUrl"),
        )).alias("data"),
    )
    return records.brooklyn(raw).select("id", "dimensions", "date_start", "origin_site_raw", "origin_certainty", "thumbnail_url", "license")


@book.query("""
WITH kept AS (SELECT * FROM part WHERE p_type IN ('PROMO', 'SMALL') OR p_partkey IN (1, 2, 3))
SELECT 'idai:' || k.p_partkey AS id, CASE WHEN k.p_size % 3 = 0 THEN k.p_size + 0.5 END AS lon, 'idai:' || k.p_size AS parent_id,
  k.p_size IN (SELECT p_partkey FROM kept) AS parent_in_file, k.p_partkey IN (1, 2, 3) AS is_supplementary, 'g' || k.p_size AS geonames, 'a1' AS arachne, 1 AS n_other FROM kept k""")
def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places by type or by a curated list, with parents, coordinates and references."""
    at = F.when(F.col("p_size") % 3 == 0, F.to_json(F.struct(F.array(F.col("p_size") + 0.5, F.lit(25.0)).alias("coordinates")))).when(F.col("p_size") % 3 == 1, "[0.0, 0.0]").otherwise("[null, 25.7]")
    ref = lambda context, value: F.struct(F.lit(context).alias("context"), value.alias("value"))
    size = F.col("p_size").cast("string")
    raw = load(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("gazId"), F.struct(F.col("p_name").alias("title")).alias("prefName"), F.array(F.struct(F.col("p_brand").alias("title"))).alias("names"),
        F.array("p_type", F.lit(None)).alias("types"), at.alias("prefLocation"), F.concat(F.lit("https://g.example/place/"), size).alias("parent"),
        F.array(ref("geonames", F.lit("g0")), ref("GeoNames", F.concat(F.lit("g"), size)), ref("arachne-entity", F.lit("a1")), ref("dai-arachne", F.lit("a2")), ref("zenon", F.lit("z"))).alias("identifiers"),
    )
    r = places.reconcile(raw, ["PROMO", "SMALL"], ["1", "2", "3"])
    return r.select("id", F.get("coordinates", F.lit(0)).alias("lon"), "parent_id", "parent_in_file", "is_supplementary", F.col("cross_refs.geonames").alias("geonames"), F.col("cross_refs.dai-arachne").alias("arachne"), F.size("cross_refs.other").alias("n_other"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'p_brand|p_name' ELSE 'p_brand' END AS keys FROM part""")
def null_free_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").withColumn("p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_name")))
    return p.select("p_partkey", F.array_join(F.array_sort(F.json_object_keys(sinks.document("p_name", "p_brand"))), "|").alias("keys"))


@book.query("""
SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return sinks.latest(e, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@book.query("SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'new ' || p_name ELSE p_name END AS p_name FROM part")
def upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    new = p.filter("p_partkey % 10 = 0").withColumn("p_name", F.concat(F.lit("new "), "p_name"))
    return sinks.upsert(p, new, ["p_partkey"])


@book.query("SELECT o_orderkey AS doc, 3 AS line_no, o_orderpriority AS title FROM orders WHERE o_orderkey % 4 <> 0")
def line_protocol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first wanted object of each response; a quarter of them has none with its number."""
    number = F.when(F.col("o_orderkey") % 4 == 0, "").otherwise("n1")
    thing = F.to_json(F.struct(F.lit("collectionObject").alias("_type"), number.alias("accessionNumber"), F.col("o_orderpriority").alias("title")))
    body = F.concat(F.lit('0:["$1"]\n1:{"_type":"other","accessionNumber":"x"}\n2a:'), thing, F.lit("\n3:I[1]\nplain text without a number: {}"))
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), body.alias("text"))
    return landed.protocol_objects(o, "collectionObject", "accessionNumber").select("doc", "line_no", F.get_json_object("payload", "$.title").alias("title"))


@book.query("""
SELECT coalesce(reason, 'in scope') AS reason, count(*) AS n FROM (
  SELECT CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 'type' WHEN p_name LIKE 'red%' OR p_name LIKE '%bolt%' THEN 'name' END AS reason FROM part) GROUP BY 1""")
def exclusion_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [("type", F.col("p_type").isin("PROMO", "LARGE")), ("name", F.col("p_name").startswith("red") | F.col("p_name").contains("bolt"))]
    return profile.excluded(load(spark, sf_dir, "part"), rules).groupBy(F.coalesce("reason", F.lit("in scope")).alias("reason")).agg(F.count("*").alias("n"))
