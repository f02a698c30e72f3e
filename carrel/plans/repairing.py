"""Proof queries of what makes versions agree, and of repairs inside values and lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.functions import claims as certainty
from carrel.functions import names, text, years
from carrel.operators import claims, clusters, consensus, guards, joins, lines, ordering, patching, profile
from carrel.plans.registry import Book
from carrel.sources import landed, sinks
from carrel.sources.staging import fresh_dir, load, tasks_for

book = Book()


@book.query("""
SELECT l_orderkey AS key, agent, count(*) AS n, min(CASE WHEN agent <> 'c' THEN l_returnflag END) AS flag, min(CASE WHEN agent <> 'a' THEN l_linestatus END) AS status
FROM (SELECT *, ['a', 'b', 'c'][l_linenumber % 3 + 1] AS agent FROM lineitem) GROUP BY 1, 2""")
def agents_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of agents that lack a field each as one table; every agent must have rows."""
    li = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), (F.col("l_linenumber") % 3).alias("m"))
    versions = {"a": li.filter("m = 0").select("key", "flag"), "b": li.filter("m = 1").select("key", "flag", "status"), "c": li.filter("m = 2").select("key", "status")}
    rows = consensus.together(versions)
    consensus.require_agents(rows, "agent", list(versions))
    return rows.groupBy("key", "agent").agg(F.count("*").alias("n"), F.min("flag").alias("flag"), F.min("status").alias("status"))


@book.query("""
SELECT p_partkey AS key, 3 AS n, '[{"transliteration":"' || translate(p_name, 'AaHxXSTDq', 'ꜣꜥḥḫẖšṯḏḳ') || '","note":"' || p_brand || '"}]' AS names FROM part""")
def canonical_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three spellings of one name that agree once they are in one spelling."""
    p = load(spark, sf_dir, "part")
    spelled = lambda c: F.array(F.struct(c.alias("transliteration"), F.col("p_brand").alias("note")))
    agents = F.array(F.struct(F.lit("a").alias("agent"), spelled(F.col("p_name")).alias("names")), F.struct(F.lit("b").alias("agent"), spelled(F.translate("p_name", "aA", "ˁɜ")).alias("names")), F.struct(F.lit("c").alias("agent"), spelled(F.translate("p_name", "aqS", "ɛḳš")).alias("names")))
    rows = p.select(F.col("p_partkey").alias("key"), F.explode(agents).alias("v")).select("key", "v.agent", consensus.canonical_names(F.col("v.names")).alias("names"))
    chosen = consensus.decide(consensus.tally(consensus.votes(rows, ["key"], "agent", ["names"], consensus.Rules()), ["key"]), ["key"])
    return chosen.select("key", F.col("n").cast("int").alias("n"), F.get_json_object("value", "$.v").alias("names"))


@book.query("""
WITH x AS (SELECT l_orderkey AS key, l_linenumber AS agent, min(l_shipdate) AS said FROM lineitem GROUP BY 1, 2),
c AS (SELECT key, said, count(*) AS n, min(agent) AS first FROM x GROUP BY 1, 2)
SELECT key, strftime(said, '%Y-%m-%d') AS said, n, count(*) OVER (PARTITION BY key, n) > 1 AS tied FROM c QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, first) = 1""")
def vote_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tie that goes to the first agent, and is told."""
    li = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("agent")).agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("said"))
    cast = consensus.votes(li, ["key"], "agent", ["said"], consensus.Rules(first_wins=True), shown=False)
    return consensus.decide(consensus.tally(cast, ["key"]), ["key"]).select("key", F.get_json_object("value", "$.v").alias("said"), "n", "tied")


@book.query("""
WITH l AS (SELECT o_orderkey AS id, o_custkey AS site, CASE o_orderkey % 8 WHEN 0 THEN 'Made in' WHEN 1 THEN 'From' WHEN 2 THEN 'Probably from' WHEN 3 THEN 'Said to be from' WHEN 4 THEN 'Possible place of use' WHEN 5 THEN 'Creation Place' WHEN 6 THEN 'Place found' ELSE 'Kept in' END AS label, o_custkey AS cust FROM orders),
k AS (SELECT cust AS id, site + id % 7 AS site, CASE WHEN label IN ('Made in', 'Creation Place') THEN 'production' WHEN label <> 'Kept in' THEN 'findspot' END AS kind,
  CASE WHEN label IN ('From', 'Place found') THEN 0 WHEN label = 'Probably from' THEN 1 WHEN label IN ('Said to be from', 'Possible place of use') THEN 2 ELSE 3 END AS rank FROM l)
SELECT id, min(CASE WHEN kind = 'production' THEN site END) AS production, CAST(min(CASE WHEN kind = 'findspot' THEN rank * 1000000000 + site END) % 1000000000 AS BIGINT) AS findspot,
  ['confirmed', 'probable', 'uncertain'][CAST(min(CASE WHEN kind = 'findspot' THEN rank END) + 1 AS INT)] AS certainty FROM k WHERE kind IS NOT NULL GROUP BY id""")
def place_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of production and of finding, told apart by the labels of a source."""
    labels = ["Made in", "From", "Probably from", "Said to be from", "Possible place of use", "Creation Place", "Place found", "Kept in"]
    label = F.get(F.array(*map(F.lit, labels)), (F.col("o_orderkey") % 8).cast("int"))
    o = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), label.alias("label"), (F.col("o_custkey") + F.col("o_orderkey") % 7).alias("site"))
    return claims.places_by_role(o, "id", "label", "site")


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 OR p_size % 6 = 1 THEN 'doubtful' ELSE 'attested' END AS existence,
  CASE WHEN p_size % 5 = 0 THEN 'probable' WHEN p_size % 3 = 0 OR p_size % 7 = 2 THEN 'uncertain' ELSE 'attested' END AS attribution FROM part""")
def certainty_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubt that someone was, and doubt of what is theirs, kept apart."""
    s = F.col("p_size")
    p = load(spark, sf_dir, "part").select("p_partkey", (s % 4 == 0).alias("eu"), F.when(s % 6 != 2, s % 6 == 1).alias("ed"), F.when(s % 5 == 0, "probable").alias("stated"), (s % 3 == 0).alias("au"), (s % 7 == 2).alias("nu"))
    return p.select("p_partkey", certainty.existence("eu", "ed").alias("existence"), certainty.attribution("stated", "au", "nu").alias("attribution"))


@book.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'Ruler-' || upper(o_orderstatus) || CASE WHEN o_orderkey % 3 = 2 THEN ' II|Other' ELSE '' END END AS rulers FROM orders""")
def reigns_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulers that the text of a date names, each once."""
    who = F.concat(F.lit("Ruler-"), "o_orderstatus")
    m = F.col("o_orderkey") % 3
    dating = F.when(m == 0, "late period").when(m == 1, F.concat(F.lit("reign of "), who)).otherwise(F.concat(F.lit("Reign of "), who, F.lit(" II to the reign of Other, reign of Other")))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.array_join(certainty.reigns_named(dating), "|").alias("rulers"))


@book.query("SELECT p_partkey, p_name || '|' || p_type || '|' || p_brand AS names FROM part")
def plain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of texts and of objects with a name, all as lists of names."""
    mixed = F.concat(F.lit('["'), "p_name", F.lit('", {"name": "'), "p_type", F.lit('", "role": "x"}, "'), "p_brand", F.lit('"]'))
    return load(spark, sf_dir, "part").select("p_partkey", F.array_join(text.plain_names(mixed), "|").alias("names"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN 'r-' || p_size || 'a,-' ELSE '-,r-' || p_size END AS ids,
  CASE WHEN p_size % 2 = 0 THEN 'uncertain' WHEN p_size % 5 = 0 THEN 'probable' END AS confidence FROM part""")
def parallel_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference of each name of a list, and how sure a hedge in any case is."""
    size, m = F.col("p_size").cast("string"), F.col("p_size") % 3
    said = F.when(m == 1, F.array(F.concat(F.lit("A ["), size, F.lit(" A]")), F.lit("B [x]"))).when(m == 2, F.array(F.lit("B"), F.concat(F.lit("A ["), size, F.lit("]"))))
    hedged = F.when(F.col("p_size") % 2 == 0, "N (?) (PROBABLE)").when(F.col("p_size") % 5 == 0, "N (Probable)").otherwise("N")
    found = names.confidence_and_reference(hedged, [("(?)", "uncertain"), ("(probable)", "probable")])
    ids = F.array_join(F.transform(names.parallel_references(said, "r-"), lambda x: F.coalesce(x, F.lit("-"))), ",")
    return load(spark, sf_dir, "part").select("p_partkey", ids.alias("ids"), found["confidence"].alias("confidence"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_name END AS note, CASE WHEN p_size % 2 = 0 THEN p_brand || ' (?)' WHEN p_size % 5 = 0 THEN 'known (?)' ELSE p_brand END AS brand FROM part""")
def restored_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tail of remarks cut over line ends, and marks restored where they are absent."""
    s = F.col("p_size")
    tail = F.lit("A vs B disagreement: one\ntwo")
    note = F.when(s % 3 == 0, tail).when(s % 3 == 1, F.concat("p_name", F.lit(". "), tail)).otherwise(F.col("p_name"))
    p = load(spark, sf_dir, "part").select("p_partkey", "p_size", text.without_tail(note, r"\s*(?:^|\. )?A vs B disagreement:").alias("note"), F.when(s % 2 == 0, F.concat("p_brand", F.lit(" (?)"))).otherwise(F.col("p_brand")).alias("brand"))
    listed = p.filter("p_size % 5 = 0").select(F.col("p_partkey").alias("key"), F.lit("known (?)").alias("value"))
    return patching.restore_marks(p, "p_partkey", "brand", listed, "(?)").select("p_partkey", "note", "brand")


@book.query("""
SELECT p_partkey, '{"a":"' || n || '","b":[{"c":"' || t || '"},{"c":null}]}' AS value FROM (SELECT p_partkey, replace(replace(p_name, 'a', 'b'), 'b', 'o') AS n, replace(replace(p_type, 'a', 'b'), 'b', 'o') AS t FROM part)""")
def replaced_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacements in order, at any depth of a value."""
    p = load(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_name").alias("a"), F.array(F.struct(F.col("p_type").alias("c")), F.struct(F.lit(None).cast("string").alias("c"))).alias("b")).alias("value"))
    changed = text.deeply(F.col("value"), p.schema["value"].dataType, lambda c: text.replaced(c, [("a", "b"), ("b", "o")]))
    return p.select("p_partkey", F.to_json(changed, {"ignoreNullFields": "false"}).alias("value"))


@book.query("""
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Thing III of Ill' WHEN p_size % 3 = 1 THEN 'THING  II' ELSE 'Nothing Il' END AS numeral,
  CASE WHEN p_size % 2 = 0 THEN 'a+b is new, New a+bc' ELSE regexp_replace(p_name, '\\bold\\b', 'new') END AS words FROM part""")
def words_and_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Misread numerals after names, and whole words that are no patterns."""
    s = F.col("p_size")
    numeral = F.when(s % 3 == 0, "Thing I  Il of Ill").when(s % 3 == 1, "THING  11").otherwise("Nothing Il")
    words = F.when(s % 2 == 0, "a+b is old, Old a+bc").otherwise(F.col("p_name"))
    return load(spark, sf_dir, "part").select("p_partkey", text.numerals_after(numeral, ["Thing"], {"i il": "III", "ill": "III", "il": "II", "ii": "II", "11": "II"}).alias("numeral"), text.words_replaced(words, {"old": "new", "a": "a"}).alias("words"))


@book.query("""
WITH n AS (SELECT o_orderkey AS doc, o_orderkey % 4 AS shape, 100 + o_orderkey % 90 AS num, o_orderpriority AS t FROM orders)
SELECT doc, 1 AS line_no, CASE WHEN shape < 3 THEN num || '. ' || t ELSE '' || num END AS line FROM n
UNION ALL SELECT doc, 2, 'Other text' FROM n WHERE shape = 3
UNION ALL SELECT doc, 3, 'body' FROM n""")
def split_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnote numbers that a line break tore apart, in three shapes; a fourth isn't one."""
    num = (100 + F.col("o_orderkey") % 90).cast("string")
    m, t = F.col("o_orderkey") % 4, F.col("o_orderpriority")
    first = F.when(m == 0, num).when(m == 1, F.concat(num, F.lit("."))).when(m == 2, F.substr(num, F.lit(1), F.lit(2))).otherwise(num)
    second = F.when(m == 0, F.concat(F.lit(". "), t)).when(m == 1, F.concat(F.lit(" "), F.lit(""), t)).when(m == 2, F.concat(F.substr(num, F.lit(3), F.lit(1)), F.lit(". "), t)).otherwise("Other text")
    o = load(spark, sf_dir, "orders").withColumn("o_orderpriority", F.col("o_orderpriority"))
    each = F.array(*(F.struct(F.lit(i).alias("line_no"), c.alias("line")) for i, c in enumerate((first, second, F.lit("body")), 1)))
    made = o.select(F.col("o_orderkey").alias("doc"), F.explode(each).alias("l")).select("doc", "l.*")
    return lines.split_numbers_merged(made)


@book.query("""
SELECT o_custkey AS doc, CAST(count(*) AS BIGINT) AS lines, 'Word.[^' || min(101) || '] and 55' AS first FROM orders GROUP BY 1""")
def anchored_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers after a word that a footnote of the page has become anchors; others stay."""
    o = load(spark, sf_dir, "orders")
    body = o.select(F.col("o_custkey").alias("doc"), F.lit("body").alias("kind"), F.lit("Word.101 and 55").alias("text"))
    notes = o.select(F.col("o_custkey").alias("doc"), F.lit("note").alias("kind"), F.lit(101).alias("number")).distinct()
    return lines.anchored(body, notes).groupBy("doc").agg(F.count("*").alias("lines"), F.min("text").alias("first"))


@book.query("""
WITH b AS (SELECT p_brand AS doc, p_partkey AS line_no, p_name AS n, p_size AS s FROM part),
l AS (SELECT doc, line_no, CASE WHEN s % 2 = 0 THEN '***' || n || '*** (x)' WHEN s % 5 = 0 THEN '**PLAIN**' WHEN s % 3 = 0 THEN '**Listed**' ELSE n END AS line, s FROM b)
SELECT doc, line_no, 2 AS part, line FROM l UNION ALL SELECT doc, line_no, 0, '## p. 7' FROM l WHERE line = '**Listed**' UNION ALL SELECT doc, line_no, 1, '' FROM l WHERE line = '**Listed**'""")
def chunk_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bold entry names in italics but for listed ones and capitals, and headers before the first entry of a page."""
    s, n = F.col("p_size"), F.col("p_name")
    line = F.when(s % 2 == 0, F.concat(F.lit("**"), n, F.lit("** (x)"))).when(s % 5 == 0, "**PLAIN**").when(s % 3 == 0, "**Listed**").otherwise(n)
    made = load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("line_no"), line.alias("line"))
    promoted = lines.italics_promoted(made, spark.createDataFrame([("Listed",)], "name string"))
    return lines.headers_inserted(promoted, spark.createDataFrame([(7, "Listed")], "page int, name string"))


@book.query("""
WITH b AS (SELECT p_brand AS doc, p_partkey AS n, p_size AS s, count(*) FILTER (p_size = 50) OVER (PARTITION BY p_brand ORDER BY p_partkey) > 0 AS late FROM part)
SELECT doc, count(*) FILTER (s % 2 = 0 AND s <> 50 AND NOT late) AS placed, count(*) FILTER (s % 2 = 0 AND s <> 50 AND late) AS unplaced, count(*) FILTER (s % 2 = 0 AND s <> 50) AS total FROM b GROUP BY 1""")
def entry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries before and after a heading, as a footer counts them."""
    s = F.col("p_size")
    line = F.when(s == 50, "### Unplaced").when(s % 2 == 0, F.concat(F.lit("**"), "p_name", F.lit("**"))).when(s % 3 == 0, "**Brief Lives**").otherwise(F.col("p_name"))
    return lines.entry_counts(load(spark, sf_dir, "part").select(F.col("p_brand").alias("doc"), F.col("p_partkey").alias("line_no"), line.alias("line")))


@book.query("""
WITH x AS (SELECT conv_id AS doc, turn, role || ' ' || length(text) AS line, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS card FROM conversations)
SELECT doc, card, string_agg(line, ' ' ORDER BY turn) AS text FROM x WHERE card > 0 GROUP BY 1, 2""")
def index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries that run from a line of a pattern to the next, white space collapsed."""
    c = load(spark, sf_dir, "conversations")
    made = c.select(F.col("conv_id").alias("doc"), F.col("turn").alias("line_no"), F.concat("role", F.lit(" \t "), F.length("text").cast("string"), F.lit(" ")).alias("line"))
    return lines.entries(made, "^user")


@book.query("""
WITH l AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)
SELECT doc, count(*) AS n, count(*) FILTER (line_no <= 10 AND regexp_matches(line, '[0-9]')) AS numbered FROM l WHERE NOT regexp_matches(line, '^(A|The) ') GROUP BY 1""")
def running_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents without those of running headers."""
    d = landed.lines(load(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text"))
    kept = lines.without_running_lines(d, ["^A ", "^The "])
    return kept.groupBy("doc").agg(F.count("*").alias("n"), F.count_if((F.col("line_no") <= 10) & F.col("line").rlike("[0-9]")).alias("numbered"))


@book.query("""
WITH l AS (SELECT p_brand AS doc, p_partkey AS n, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS line_no, p_type, p_size FROM part)
SELECT doc, arg_max(p_type, line_no) FILTER (p_size % 2 = 0) AS kind, CAST(arg_max(p_size, line_no) FILTER (p_size % 2 = 1) AS VARCHAR) AS size FROM l WHERE line_no <= 10 GROUP BY 1""")
def introduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first lines of a document say, the last of each kind."""
    p = load(spark, sf_dir, "part")
    at = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    line = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Kind: "), "p_type")).otherwise(F.concat(F.lit("Size: "), F.col("p_size").cast("string")))
    return lines.introduction(p.select(F.col("p_brand").alias("doc"), at.alias("line_no"), line.alias("line")), {"kind": "^Kind: (.*)$", "size": "^Size: (.*)$"})


@book.query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'see note 12 of pre-war ' || o_orderstatus ELSE o_orderpriority END AS normal FROM orders""")
def normal_for_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" see *note* [^12]  of pre- \n war "), "o_orderstatus")).otherwise(F.concat("o_orderpriority", F.lit(" ")))
    return load(spark, sf_dir, "orders").select("o_orderkey", text.normal_for_diff(said).alias("normal"))


@book.query("""
SELECT p_brand || '|' || p_type AS locator, min(p_partkey) AS key FROM part GROUP BY p_brand, p_type""")
def locate_migrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locators by old labels, half of which a run before has moved to new ones already."""
    p = load(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).agg(F.min("p_partkey").alias("key"))
    rows = p.select("key", F.col("brand"), F.when(F.col("key") % 2 == 0, F.concat(F.lit("new "), "type")).otherwise(F.col("type")).alias("type"))
    loc = p.select(F.concat_ws("|", "brand", "type").alias("locator"), "brand", "type", F.concat(F.lit("new "), "type").alias("after"))
    return joins.locate_migrated(rows, "key", loc, ["brand", "type"], "type", "after")


@book.query("""
SELECT count(*) AS total, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS assigned, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) AS abstained,
  round(count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM labels)) / count(*)::DOUBLE, 9) AS rate FROM documents""")
def abstention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of all documents have no label."""
    d, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    return clusters.abstention(d.select(F.col("doc_id").alias("id")), labels.select(F.col("doc_id").alias("id"))).withColumn("rate", F.round("rate", 9))


@book.query("SELECT count(*) FILTER (event_type <> 'error' AND value >= 10) AS stored, count(*) FILTER (event_type <> 'error' AND value < 10) AS skipped, count(*) FILTER (event_type = 'error') AS errors FROM events")
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.outcomes(load(spark, sf_dir, "events"), F.col("event_type") == "error", F.col("value") < 10)


@book.query("""
SELECT event_id AS id, CASE WHEN event_id % 5 = 0 THEN 'm|j' WHEN event_id % 3 = 0 THEN 'm' END AS missing FROM events WHERE event_id % 5 = 0 OR event_id % 3 = 0""")
def missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the fields that every document should have one lacks; a null one is there."""
    e = load(spark, sf_dir, "events")
    data = F.when(F.col("event_id") % 5 == 0, '{"k": 1}').when(F.col("event_id") % 3 == 0, '{"k": 1, "j": null}').otherwise('{"k": 1, "m": 2, "j": 3}')
    found = guards.missing_fields(e.select("event_id", data.alias("data")), "event_id", "data", ["k", "m", "j"])
    return found.select("id", F.array_join("missing", "|").alias("missing"))


@book.query("""
SELECT a.l_orderkey AS a, a.l_partkey AS b FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a
WHERE NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_partkey AND b.l_partkey = a.l_orderkey)""")
def unsymmetric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"))
    return guards.unsymmetric(pairs, "a", "b", tasks_for(pairs))


@book.query("""
SELECT p_partkey, CASE WHEN p_size >= 45 THEN 'large' WHEN p_brand = 'Brand#3' THEN 'third' ELSE 'rest' END AS label, p_partkey % 7 = 0 OR p_type = 'PROMO' AS flag,
  CASE WHEN p_size % 2 = 0 THEN p_type END AS kind FROM part""")
def labels_and_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of the first pattern that matches; a flag by a set of ids or by a pattern; notes without the row's own name."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type", F.concat("p_brand", F.lit(" size "), F.col("p_size").cast("string")).alias("t"), F.when(F.col("p_size") % 2 == 0, F.concat("p_name", F.lit(", "), "p_type")).otherwise(F.concat("p_name", F.lit("."))).alias("notes"), "p_name")
    p = p.withColumn("label", text.first_label("t", [("large", r" (4[5-9]|\d{3}|[5-9]\d)$"), ("third", r"^Brand#3\b")], "rest"))
    flagged = patching.members_or_pattern(p, "p_partkey", p.filter("p_partkey % 7 = 0").select("p_partkey"), "p_type", "^PROMO$", "flag")
    return flagged.select("p_partkey", "label", "flag", names.without_own_name("notes", "p_name").alias("kind"))


@book.query("""
SELECT 'sizes' AS stage, p_partkey, 'p_size' AS field, CAST(p_size AS VARCHAR) AS before, '0' AS after FROM part WHERE p_size > 40
UNION ALL SELECT 'names', p_partkey, 'p_name', p_name, 'none' FROM part WHERE p_size > 40""")
def stages_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stages that run one after the other, with the cells that each changed: the second sees what the first set."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    stages = [("sizes", lambda df: df.withColumn("p_size", F.when(F.col("p_size") <= 40, F.col("p_size")).otherwise(0))), ("names", lambda df: df.withColumn("p_name", F.when(F.col("p_size") == 0, "none").otherwise(F.col("p_name"))))]
    return patching.in_order(p, stages, ["p_partkey"], ["p_name", "p_size"])[1]


@book.query("""
SELECT p_partkey, p_size * 10 - 250 < 0 AND p_size * 10 - 100 > 0 AS crosses, CASE WHEN p_size % 3 = 0 THEN 'none' WHEN p_size % 3 = 1 THEN 'start_only' ELSE 'both' END AS known,
  CASE WHEN p_size % 2 = 0 THEN 'fixed' ELSE p_brand END AS backed FROM part""")
def eras_and_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges over the turn of eras, which of their years are known, and columns filled in where they are missing."""
    s = F.col("p_size")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", years.crosses_era(s * 10 - 250, s * 10 - 100).alias("crosses"), years.attested(F.when(s % 3 != 0, s), F.when(s % 3 == 2, s)).alias("known"))
    backed = patching.backfill(p, {"backed": F.when(F.col("p_size") % 2 == 0, "fixed").otherwise(F.col("p_brand")), "p_size": F.lit(0)})
    return backed.select("p_partkey", "crosses", "known", "backed")


@book.query("""
SELECT p_partkey, '{"a":[{"b":"' || p_name || '"},{"b":"set"}]}' AS value, '2' || p_brand[7:] AS place FROM part""")
def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value replaced inside a list, and the parts of an id by a pattern."""
    value = F.struct(F.array(F.struct(F.col("p_name").alias("b")), F.struct(F.col("p_type").alias("b"))).alias("a"))
    place = ordering.parsed(F.concat(F.lit("2-"), "p_brand"), r"^(\d+)-Brand#(\w+)$", [True, False])
    return load(spark, sf_dir, "part").select("p_partkey", F.to_json(patching.set_path(value, ["a", 1, "b"], F.lit("set"))).alias("value"), F.concat(place[0].cast("string"), place[1]).alias("place"))


@book.query("SELECT p_partkey, p_name, CASE WHEN p_size % 2 = 0 THEN p_size END AS p_size FROM part")
def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-free documents written as JSON lines and read back; a key may stand once."""
    folder = fresh_dir(spark, "json-lines")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("p_size"))
    sinks.write_documents(p, folder, "p_partkey")
    return landed.json_lines(spark, folder, p.schema, ["p_partkey"]).drop("file")


@book.query("SELECT n_nationkey, n_name, n_regionkey, 1 AS n FROM nation")
def sorted_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted JSON lines with nulls, the same bytes in two runs."""
    n, folders = load(spark, sf_dir, "nation"), [fresh_dir(spark, "sorted-json") for _ in range(2)]
    for folder, rows in zip(folders, (n, n.orderBy(F.desc("n_name"))), strict=True):
        sinks.write_sorted_json(rows, folder, ["n_nationkey"])
    both = spark.read.text(folders[0]).distinct().join(spark.read.text(folders[1]), "value")
    return both.select(F.from_json("value", n.schema).alias("r"), F.lit(1).alias("n")).select("r.*", "n")


@book.query("""
WITH x AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS c, lag(doc_id) OVER (PARTITION BY lang ORDER BY doc_id) AS before FROM documents)
SELECT x.before AS a, x.doc_id AS b FROM x JOIN x y ON y.doc_id = x.before WHERE x.c <> y.c""")
def split_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs that should be together and stand in different clusters."""
    d = load(spark, sf_dir, "documents")
    pairs = d.select(F.lag("doc_id").over(Window.partitionBy("lang").orderBy("doc_id")).alias("a"), F.col("doc_id").alias("b")).filter("a is not null")
    return clusters.split_pairs(pairs, clusters.by_equal(d, "doc_id", "text"))

@book.query("""
SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#3%' THEN 'third' ELSE 'any' END AS label, CASE WHEN p_partkey % 4 = 0 THEN 'first' WHEN p_partkey % 6 = 0 THEN 'second' ELSE 'rest' END AS kind,
  CASE WHEN p_type = 'PROMO' THEN 'promo' ELSE p_name END AS name FROM part""")
def prefixes_and_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by the longest prefix, kinds by the first set of ids, and a change to the rows of one type alone."""
    p = load(spark, sf_dir, "part").select("p_partkey", text.prefix_label("p_brand", {"Brand": "any", "Brand#3": "third"}).alias("label"), "p_type", F.col("p_name").alias("name"))
    kinds = patching.first_set(p, "p_partkey", [("first", p.filter("p_partkey % 4 = 0").select("p_partkey")), ("second", p.filter("p_partkey % 6 = 0").select("p_partkey"))], "kind", "rest")
    return patching.scoped(kinds, F.col("p_type").startswith("PROMO"), lambda df: df.withColumn("name", F.lit("promo"))).drop("p_type")


@book.query("""
SELECT 'n' || c_nationkey AS subject, 'holds' AS predicate, 'c' || c_custkey AS object, 'nation' AS subject_type, CASE WHEN c_custkey % 3 <> 0 THEN 'customer' END AS object_type FROM customer WHERE c_custkey % 3 = 0 OR c_nationkey % 2 = 1""")
def mistyped_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims between things of types that their predicate doesn't allow, or of none."""
    c = load(spark, sf_dir, "customer")
    node = lambda p, x: F.concat(F.lit(p), F.col(x).cast("string"))
    edges = c.select(node("n", "c_nationkey").alias("subject"), F.lit("holds").alias("predicate"), node("c", "c_custkey").alias("object"))
    types = c.select(node("n", "c_nationkey").alias("node"), F.lit("nation").alias("type")).distinct().unionByName(c.filter("c_custkey % 3 <> 0").select(node("c", "c_custkey").alias("node"), F.lit("customer").alias("type")))
    even = edges.filter(F.substr("subject", F.lit(2)).cast("int") % 2 == 0)
    odd = edges.filter(F.substr("subject", F.lit(2)).cast("int") % 2 == 1)
    allowed = lambda *r: spark.createDataFrame(list(r), "predicate string, subject_type string, object_type string")
    return guards.mistyped(even, types, allowed(("holds", "nation", "customer"))).unionByName(guards.mistyped(odd, types, allowed(("holds", "region", "customer"))))


@book.query("""
WITH x AS (SELECT DISTINCT l_suppkey AS id, l_partkey AS v FROM lineitem)
SELECT id, min(id) OVER (PARTITION BY v) AS "group", count(*) OVER (PARTITION BY v) AS n FROM x QUALIFY count(*) OVER (PARTITION BY v) > 1""")
def sharing_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of a part as members of its group, instead of all their pairs."""
    return claims.sharing_groups(load(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


@book.query("""
SELECT c_custkey AS id, 'near' AS tier, min(c_custkey) OVER w AS "group", count(*) OVER w AS n FROM customer WINDOW w AS (PARTITION BY c_nationkey, c_mktsegment) QUALIFY count(*) OVER w > 1
UNION ALL SELECT c_custkey, 'far', min(c_custkey) OVER w, count(*) OVER w FROM customer WINDOW w AS (PARTITION BY c_mktsegment) QUALIFY count(*) OVER w > 1""")
def companion_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that belong together, by two tiers, as members of groups."""
    items = load(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "id")
    return joins.companion_groups(items, [("near", ["c_nationkey", "c_mktsegment"]), ("far", ["c_mktsegment"])])


@book.query("""
SELECT o_orderkey AS mention, CASE o_orderstatus WHEN 'F' THEN 'accepted' WHEN 'O' THEN 'rejected' ELSE 'pending' END AS status FROM orders""")
def review_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of several verdicts on each mention of a queue."""
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("mention"), "o_orderstatus")
    said = o.filter("o_orderstatus IN ('F', 'O')")
    first = said.select("mention", F.lit("rejected").alias("status"), F.lit(1).alias("at"))
    second = said.filter("o_orderstatus = 'F'").select("mention", F.lit("accepted").alias("status"), F.lit(2).alias("at"))
    return joins.review_states(o.select("mention", F.lit("pending").alias("status")), first.unionByName(second))


@book.query("""
SELECT n_nationkey + 1 AS line_no, n_name AS line FROM nation WHERE n_nationkey < 20 UNION ALL SELECT 21, '# section' UNION ALL SELECT 22 + r_regionkey, r_name FROM region""")
def section_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log whose section from a marker on is replaced; doing it twice changes nothing more."""
    n = load(spark, sf_dir, "nation")
    log = n.select((F.col("n_nationkey") + 1).alias("line_no"), F.when(F.col("n_nationkey") == 20, "# section").otherwise(F.col("n_name")).alias("line"))
    section = load(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).cast("long").alias("line_no"), F.col("r_name").alias("line"))
    once = sinks.section_replaced(log, "# section", section)
    return sinks.section_replaced(once, "# section", section)


@book.query("SELECT 'lineitem' AS name, count(*) AS rows, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem")
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a write measures of its rows as it goes."""
    rows, seen = profile.observed(load(spark, sf_dir, "lineitem"), "lineitem", quantity=F.sum("l_quantity"))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([("lineitem", int(seen.get["rows"]), int(seen.get["quantity"]))], "name string, rows long, quantity long")


@book.query("""
SELECT p_partkey AS id, 'Other' || p_size AS candidate FROM part WHERE p_size % 2 = 0""")
def harvest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of kin in prose that are neither part of a known one nor have one as a part."""
    p = load(spark, sf_dir, "part")
    other = F.concat(F.lit("Other"), F.col("p_size").cast("string"))
    prose = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("son of Known; son of "), other, F.lit(";"))).otherwise("son of Known the Elder;")
    rows = p.select(F.col("p_partkey"), prose.alias("prose"), F.array(F.lit("Known")).alias("known"))
    return lines.harvest(rows, "p_partkey", "prose", "known", [r"son of ([^;]+);"], parts=True)


@book.query("""
SELECT p_partkey, p_size % 8 = 0 AS marker, p_size % 5 = 0 AS anti, p_size % 8 IN (1, 2, 3, 4) AS uncertain, p_size % 8 IN (2, 6, 7) OR p_size % 5 = 1 AS doubtful,
  CASE WHEN p_size % 7 = 0 THEN 'geological' WHEN p_size % 3 = 0 THEN 'regnal_precise' ELSE 'regnal_approximate' END AS precision FROM part""")
def doubtful_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What marks of names and notes say of a row: heading, anti-king, uncertain or doubtful existence, precision of its date."""
    s = F.col("p_size")
    wrap = lambda before, after: F.concat(F.lit(before), "p_name", F.lit(after))
    shapes = [F.concat(s.cast("string"), F.lit("./9. Dynastie")), wrap("(", ")"), wrap("", " (?) "), wrap("? ", ""), wrap("von „", "“"), wrap("x 'a' ", ""), wrap("'", "' "), wrap("", "?? ")]
    notes = F.when(s % 5 == 0, "er war Gegenkönig.").when(s % 5 == 1, "Existence,  doubtful").otherwise("hatte Gegenkönige, existence not doubtful")
    p = load(spark, sf_dir, "part").select("p_partkey", s, F.get(F.array(*shapes), s % 8).alias("name"), notes.alias("notes"), F.when(s % 3 != 0, "c.").alias("q"))
    return p.select("p_partkey", names.is_dynasty_marker("name").alias("marker"), names.is_anti_king("notes").alias("anti"), names.existence_uncertain("name").alias("uncertain"), names.existence_doubtful("name", "notes").alias("doubtful"), years.precision("q", s % 7 == 0).alias("precision"))
