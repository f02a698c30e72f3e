"""Proof queries of line-oriented text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.functions import names, text
from carrel.operators import lines
from carrel.plans.registry import Book
from carrel.sources import landed, places
from carrel.sources.staging import load

book = Book()


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: a turn is a line that begins with its role."""
    c = load(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("line_no"), F.concat("role", F.lit(": "), F.length("text").cast("string")).alias("line"))


@book.query("""
SELECT conv_id AS doc, turn AS line_no, last_value(CASE WHEN role <> 'assistant' THEN role || ': ' || length(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations""")
def heading_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last line of a person or the system at or above each line."""
    return lines.carried(_turns(spark, sf_dir), F.when(~F.col("line").startswith("assistant"), F.col("line")), "heading").select("doc", "line_no", "heading")


@book.query("""
WITH x AS (SELECT conv_id AS doc, turn AS line_no, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS card FROM conversations)
SELECT doc, line_no, card, row_number() OVER (PARTITION BY doc, card ORDER BY line_no) - 1 AS "at" FROM x WHERE card > 0""")
def card_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards that a user's line starts."""
    return lines.cards(_turns(spark, sf_dir), F.col("line").startswith("user")).select("doc", "line_no", "card", F.col("at").cast("long").alias("at"))


@book.query("""
WITH l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
SELECT doc, line_no, first_value(CASE WHEN trim(line) <> '' THEN line END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_line FROM l""")
def next_nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = landed.lines(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text"))
    return lines.next_filled(d).select("doc", "line_no", "next_line")


@book.query("""
SELECT p_brand AS doc, p_type AS key, arg_max(p_name, p_partkey) AS value FROM part WHERE p_type <> 'PROMO' GROUP BY 1, 2""")
def kv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-cell rows as a map, the last of a repeated key winning, one label skipped."""
    row = F.concat(F.lit("| "), "p_type", F.lit(" |  "), "p_name", F.lit(" |"))
    made = load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("line_no"), row.alias("line"))
    return lines.key_values(made, ["PROMO"])


@book.query("""
WITH l AS (SELECT p_brand AS doc, p_partkey AS n, p_type = 'PROMO' AS label, CASE WHEN p_size % 3 = 0 THEN p_name END AS value FROM part),
a AS (SELECT *, coalesce(lead(value, 1) OVER w, lead(value, 2) OVER w, lead(value, 3) OVER w, lead(value, 4) OVER w) AS ahead FROM l WINDOW w AS (PARTITION BY doc ORDER BY n))
SELECT doc, ahead AS value FROM a WHERE label QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n) = 1""")
def value_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first filled value on the four lines after a document's first label."""
    p = load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("line_no"), "p_type", F.when(F.col("p_size") % 3 == 0, F.col("p_name")).alias("v"))
    return lines.value_after(p, F.col("p_type") == "PROMO", F.col("v"))


@book.query("""
SELECT p_brand AS doc, p_partkey AS line_no, CASE WHEN s = 0 THEN 'header' WHEN t = 'PROMO' THEN 'promo' ELSE 'other' END AS section FROM (
  SELECT *, count(*) FILTER (p_size % 10 = 0) OVER w AS s, last_value(CASE WHEN p_size % 10 = 0 THEN p_type END IGNORE NULLS) OVER w AS t FROM part WINDOW w AS (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING))
WHERE p_size % 10 <> 0""")
def section_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.when(F.col("p_size") % 10 == 0, F.concat(F.lit(" ## "), "p_type", F.lit(" "))).otherwise(F.col("p_name"))
    made = load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("line_no"), line.alias("line"))
    return lines.sections(made, {"PROMO": "promo"}).select("doc", "line_no", "section")


@book.query("""
SELECT p_partkey, p_type || ' (' || p_brand || ')' AS gloss, CASE WHEN p_size % 2 = 0 THEN 'name: ' || translate(p_name, 'ab', 'xy') ELSE p_name END AS spelled,
  CASE WHEN p_size <= 39 THEN p_size END AS ordinal FROM part""")
def glosses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last balanced parenthesis, letters replaced only after a label, ordinals in words."""
    ones = ["", "first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth"]
    teens = ["tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth"]
    tens = [f"{t}-{w}" if w else z for t, z in (("twenty", "twentieth"), ("thirty", "thirtieth")) for w in ones]
    spoken = F.coalesce(F.get(F.array(*map(F.lit, [*ones, *teens, *tens])), F.col("p_size")), F.lit("last"))
    p = load(spark, sf_dir, "part")
    line = F.concat("p_name", F.lit(" (x) ("), "p_type", F.lit(" ("), "p_brand", F.lit(")) "))
    made = p.select("p_partkey", line.alias("line"), F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("name: "), "p_name")).otherwise(F.col("p_name")).alias("s"), F.concat(F.lit("## The "), spoken, F.lit(" Dynasty")).alias("h"))
    return lines.with_gloss(made).select("p_partkey", "gloss", lines.translated_span("s", "name: ", {"a": "x", "b": "y"}).alias("spelled"), names.ordinal_word("h").alias("ordinal"))


@book.query("""
SELECT conv_id AS doc, array_to_string(list_distinct_order, '|') AS labels FROM (
  SELECT conv_id, list(role ORDER BY t) AS list_distinct_order FROM (SELECT conv_id, role, min(turn) AS t FROM conversations WHERE role <> 'system' GROUP BY 1, 2) GROUP BY 1)""")
def label_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered labels, each once, without the displayed one and without dashes."""
    c = load(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc")).agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    own = F.transform("t", lambda x: x["role"])
    made = c.select("doc", text.labels(F.lit("system"), F.array(F.lit("-")), own, own).alias("l")).filter(F.size("l") > 0)
    return made.select("doc", F.array_join("l", "|").alias("labels"))


@book.query("""
SELECT p_partkey, p_brand || '|' || upper(p_name[1]) || replace(p_name[2:], ' ', '') || 're|' || p_type AS aliases FROM part""")
def alias_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index and page labels, the compact form of a name, a transcription without its symbol."""
    p = load(spark, sf_dir, "part")
    found = places.aliases(F.col("p_name"), F.array("p_brand", F.lit("–")), F.array("p_brand", "p_name"), F.concat("p_name", F.lit(" Ra")), F.array(F.concat("p_type", F.lit(" ♀"))))
    return p.select("p_partkey", F.array_join(found, "|").alias("aliases"))


@book.query("""
WITH l AS (SELECT o_custkey AS doc, o_orderkey AS line_no, o_orderpriority AS line FROM orders), h AS (
  SELECT *, sum((line = '1-URGENT')::INT) OVER w AS part FROM l WINDOW w AS (PARTITION BY doc ORDER BY line_no ROWS UNBOUNDED PRECEDING)), f AS (
  SELECT *, last_value(CASE WHEN line = '2-HIGH' THEN line END IGNORE NULLS) OVER (PARTITION BY doc, part ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS heading, lead(line) OVER (PARTITION BY doc ORDER BY line_no) AS next FROM h)
SELECT doc, line_no, 0 AS part, line FROM f
UNION ALL SELECT doc, line_no, 1, '<!-- context: ' || heading || ' -->' FROM f WHERE line = '5-LOW' AND heading IS NOT NULL AND coalesce(next, '') NOT IN ('1-URGENT', '2-HIGH')""")
def page_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heading repeated after page marks, unless one follows; sections forget it."""
    made = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("line_no"), F.col("o_orderpriority").alias("line"))
    return lines.with_context(made, "^1-", "^2-", "^5-")


@book.query("""
SELECT p_brand AS doc, string_agg(p_name, chr(10) ORDER BY p_partkey) AS text FROM part GROUP BY 1""")
def page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), "p_partkey", F.col("p_name").alias("line"))
    return lines.assembled(made, ["p_partkey"])


@book.query("""
SELECT o_custkey AS doc, 100 + row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS number, 'note of ' || o_orderpriority || ' kind' AS text FROM orders""")
def page_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnotes at the end of pages: every customer's orders are notes below one body line."""
    o = load(spark, sf_dir, "orders")
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    notes = o.select(F.col("o_custkey").alias("doc"), n.alias("line_no"), F.concat((n + 100).cast("string"), F.lit(". note of "), "o_orderpriority", F.lit(" kind")).alias("line"))
    body = notes.select("doc", F.lit(0).alias("line_no"), F.lit("body text").alias("line")).distinct()
    found = lines.footnotes(notes.unionByName(body))
    return found.filter("kind = 'note'").select("doc", F.col("number").cast("long").alias("number"), "text")


@book.query("""
SELECT conv_id AS id, count(DISTINCT role) AS n FROM conversations WHERE role <> 'system' GROUP BY 1""")
def harvest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that prose holds and the structured column lacks."""
    c = load(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.collect_list(F.concat(F.lit("called "), "role", F.lit(";"))), " ").alias("prose"))
    found = lines.harvest(c.withColumn("known", F.array(F.lit("Sys tem"))), "conv_id", "prose", "known", [r"called (\w+);"])
    return found.groupBy("id").agg(F.count("*").alias("n"))


@book.query("""
SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, 'href="([^"]*)"')) AS links FROM pages""")
def html_title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)).cast("long").alias("links"))
