"""Proof queries of faceted search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.operators import postings, search
from carrel.plans.registry import Book
from carrel.sources.staging import fresh_dir, load, stage

book = Book()

FIELDS = {"p_name": 2.0, "p_type": 1.0}
QUERY = search.Query("Red widget", {"p_type": "SMALL"}, page=1, page_size=24)


@book.query("""
SELECT p_partkey, p_name, p_brand, CAST(4 AS DOUBLE) AS score, row_number() OVER (ORDER BY p_partkey) AS rank FROM part
WHERE p_type = 'SMALL' AND list_contains(string_split(lower(p_name), ' '), 'red') AND list_contains(string_split(lower(p_name), ' '), 'widget') QUALIFY rank <= 24""")
def search_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faceted full-text search: all words, one filter, weighted fields, the first page."""
    found = search.hits(load(spark, sf_dir, "part"), "p_partkey", FIELDS, QUERY)
    return search.page(found, "p_partkey", QUERY).select("p_partkey", "p_name", "p_brand", "score", F.col("rank").cast("long").alias("rank"))


@book.query("""
SELECT p_partkey, CASE WHEN list_contains(string_split(lower(p_name), ' '), 'small') THEN CAST(2 AS DOUBLE) ELSE 0 END + CASE WHEN lower(p_type) = 'small' THEN 1 ELSE 0 END AS score,
  row_number() OVER (ORDER BY CASE WHEN list_contains(string_split(lower(p_name), ' '), 'small') THEN 2.0 ELSE 0.0 END + CASE WHEN lower(p_type) = 'small' THEN 1.0 ELSE 0.0 END DESC, p_partkey) AS rank
FROM part WHERE list_contains(string_split(lower(p_name), ' '), 'small') OR lower(p_type) = 'small' QUALIFY rank BETWEEN 21 AND 30""")
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third page of ten, by score over two fields."""
    q = search.Query("small", page=3, page_size=10)
    return search.page(search.hits(load(spark, sf_dir, "part"), "p_partkey", FIELDS, q), "p_partkey", q).select("p_partkey", "score", F.col("rank").cast("long").alias("rank"))


@book.query("""
SELECT count(*) AS found, CAST(ceil(count(*) / 24) AS BIGINT) AS pages FROM part WHERE len([x FOR x IN string_split(lower(p_name), ' ') IF levenshtein(x, 'wiget') <= 1]) > 0""")
def search_typo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and pages of a misspelt word, one edit allowed, from the stored index."""
    q = search.Query("wiget", typos=1)
    return search.totals(postings.found(spark, _stored(spark, sf_dir, "part", "p_partkey", {"p_name": 1.0}), q), q)


def _stored(spark: SparkSession, sf_dir: str, table: str, id_: str, fields: dict[str, float]) -> postings.Index:
    return postings.write(load(spark, sf_dir, table), id_, fields, fresh_dir(spark, "search-index"))


_WORDS = r"[x FOR x IN string_split_regex(lower(text), '[^\p{L}\p{M}\p{N}]+') IF x <> '']"


@book.query(f"""
WITH t AS (SELECT doc_id, {_WORDS} AS w FROM documents)
SELECT doc_id AS id, CAST(2 AS DOUBLE) AS score FROM t
WHERE len([x FOR x IN w IF levenshtein(x, 'thei') <= 1]) > 0 AND len([x FOR x IN w IF levenshtein(x, 'wat') <= 1 OR starts_with(x, 'wat')]) > 0""")
def search_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a word within one edit of the first one and a word that is near or begins with the second."""
    index = _stored(spark, sf_dir, "documents", "doc_id", {"text": 1.0})
    return postings.found(spark, index, search.Query("Thei WAT", typos=1, prefix=True))


@book.query("""
SELECT p_partkey AS id, 2.0::DOUBLE * list_contains(string_split(lower(p_name), ' '), 'small')::INT + (lower(p_type) = 'small')::INT AS score FROM part
WHERE list_contains(string_split(lower(p_name), ' '), 'small') OR lower(p_type) = 'small' ORDER BY score DESC, id LIMIT 50""")
def search_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best rows of a word over two fields, by bounds of blocks."""
    return postings.best(spark, _stored(spark, sf_dir, "part", "p_partkey", FIELDS), search.Query("small"), 50)


@book.query("""
SELECT facet, value, count(*) AS n FROM (SELECT unnest(['p_brand', 'p_size', 'word']) AS facet, unnest([p_brand, CAST(p_size AS VARCHAR), string_split(p_name, ' ')[1]]) AS value FROM part WHERE p_type = 'SMALL'
  UNION ALL SELECT 'word', string_split(p_name, ' ')[2] FROM part WHERE p_type = 'SMALL') GROUP BY ALL""")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of each facet counted over the hits, those of array columns one by one."""
    p = load(spark, sf_dir, "part").withColumn("word", F.split("p_name", " "))
    return search.facets(search.filtered(p, search.Query(filters={"p_type": "SMALL"})), ["p_brand", "p_size", "word"])


@book.query("""
SELECT facet, value, n, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rank FROM (
  SELECT 'p_brand' AS facet, p_brand AS value, count(*) AS n FROM part GROUP BY 2 UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY 2) QUALIFY rank <= 20""")
def facet_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.facets(load(spark, sf_dir, "part"), ["p_brand", "p_size"], 20).withColumn("rank", F.col("rank").cast("long"))


@book.query("""
WITH t AS (SELECT doc_id, list_distinct([x FOR x IN string_split_regex(lower(text), '[^a-z0-9]+') IF x <> '']) AS w FROM documents)
SELECT doc_id AS id, CAST(2 AS DOUBLE) AS score FROM t WHERE list_contains(w, 'the') AND list_contains(w, 'for')""")
def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inverted index over whole documents, and a query of two words against it."""
    return search.search_index(search.index(load(spark, sf_dir, "documents"), "doc_id", {"text": 1.0}), ["the", "for"])


@book.query("""
SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN 'Untitled' ELSE p_name END AS title, CASE WHEN p_size % 3 = 0 THEN p_brand ELSE p_type END AS site, CASE WHEN p_size % 2 = 0 THEN p_type END AS period, 'The Met' AS museum FROM part""")
def result_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    size = F.col("p_size")
    rows = p.select(
        F.col("p_partkey").alias("id"), F.when(size % 4 != 0, F.col("p_name")).otherwise("").alias("title"), F.when(size % 3 == 0, F.col("p_brand")).alias("origin_site_display_name"), F.col("p_type").alias("origin_site_raw"),
        F.lit(None).cast("string").alias("dynasty"), F.when(size % 2 != 0, "someone").alias("ruler_display_name"), F.col("p_type").alias("period"), F.lit("met").alias("source_museum"),
    )
    return search.card(rows, {"met": "The Met"})


@book.query("""
SELECT facet, value, count(*) AS n FROM (SELECT p_partkey, unnest(['p_brand', 'p_size', 'word', 'word']) AS facet, unnest([p_brand, CAST(p_size AS VARCHAR), string_split(p_name, ' ')[1], CASE WHEN string_split(p_name, ' ')[2] <> string_split(p_name, ' ')[1] THEN string_split(p_name, ' ')[2] END]) AS value
  FROM part WHERE p_type = 'SMALL' AND list_contains(string_split(p_name, ' '), (SELECT min(string_split(p_name, ' ')[1]) FROM part))) WHERE value IS NOT NULL GROUP BY ALL""")
def facet_drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet counts under two filters from stored bitmaps."""
    p = load(spark, sf_dir, "part").withColumn("word", F.split("p_name", " "))
    stored = stage(search.facet_index(p, "p_partkey", ["p_brand", "p_size", "word", "p_type"]), "facets")
    word = p.agg(F.min(F.col("word")[0])).first()[0]
    return search.facet_counts(stored, {"p_type": "SMALL", "word": word}, ["p_brand", "p_size", "word"])
