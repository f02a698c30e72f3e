"""Faceted full-text search over a table: an inverted index, filters, facets, ranks and pages."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrel.functions.text import col, looked_up, tokens

PAGE_SIZE = 24
LARGEST_PAGE = 100


@dataclass(frozen=True)
class Query:
    """text ``*``: all rows; empty: all rows that filters, if there are any, leave. filters: field to value. typos: edits allowed a word.

    prefix: the last word may also begin a longer one.
    """

    text: str = "*"
    filters: dict[str, str] = field(default_factory=dict)
    page: int = 1
    page_size: int = PAGE_SIZE
    typos: int = 0
    prefix: bool = False

    def words(self) -> list[str]:
        low = "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in self.text.lower())
        return list(dict.fromkeys(low.split()))

    def asks(self) -> bool:
        return bool(self.text.strip() or any(self.filters.values()))

    def window(self) -> tuple[int, int]:
        """(rows to skip, rows to show)."""
        size = min(max(int(self.page_size), 1), LARGEST_PAGE)
        return (max(int(self.page), 1) - 1) * size, size


def index(rows: DataFrame, id_: str, fields: dict[str, float]) -> DataFrame:
    """(token, id, weight): a token of several fields has the sum of their weights."""
    parts = F.array(*(F.struct(F.lit(w).alias("weight"), F.array_distinct(tokens(f)).alias("tokens")) for f, w in fields.items()))
    each = rows.select(F.col(id_).alias("id"), F.explode(parts).alias("p")).select("id", "p.weight", F.explode("p.tokens").alias("token"))
    return each.groupBy("token", "id").agg(F.sum("weight").alias("weight"))


def filtered(rows: DataFrame, query: Query) -> DataFrame:
    """Rows equal to each filter; for an array column, those that hold the value."""
    kinds = dict(rows.dtypes)
    for f, value in query.filters.items():
        clean = value.replace("`", "")
        rows = rows.filter(F.array_contains(f, clean) if kinds[f].startswith("array") else F.col(f) == clean)
    return rows


def hits(rows: DataFrame, id_: str, fields: dict[str, float], query: Query) -> DataFrame:
    """Rows with all words of the query, and their score: the weights of the fields that hold them.

    One scan of the rows: scores are column expressions, so filters and columns reach the files. A
    query of no text and no filters finds nothing and reads nothing.
    """
    rows = filtered(rows, query) if query.asks() else rows.filter(F.lit(False))
    words = query.words() if query.text.strip() not in ("", "*") else []
    score, every = F.lit(0.0), F.lit(True)
    for i, w in enumerate(words):
        begins = query.prefix and i == len(words) - 1
        # a field without tokens counts as one without the word
        own = [F.when(F.coalesce(_holds(f, w, query.typos, begins), F.lit(False)), F.lit(float(weight))).otherwise(F.lit(0.0)) for f, weight in fields.items()]
        total = sum(own[1:], own[0])
        score, every = score + total, every & (total > 0)
    return rows.filter(every).withColumn("score", score)


def _holds(f: str, word: str, typos: int, begins: bool = False) -> Column:
    if not typos and not begins:
        return F.array_contains(tokens(f), word)
    begun = lambda t: t.startswith(word) if begins else F.lit(False)
    return F.exists(tokens(f), lambda t: (F.levenshtein(t, F.lit(word), typos) >= 0) | begun(t))


def search_index(found: DataFrame, words: list[str]) -> DataFrame:
    """(id, score) of ids that hold all words, from an index written before."""
    hit = found.filter(F.col("token").isin(words)).groupBy("id").agg(F.count("*").alias("n"), F.sum("weight").alias("score"))
    return hit.filter(F.col("n") == len(words)).select("id", "score")


def page(found: DataFrame, id_: str, query: Query) -> DataFrame:
    """The rows of the query's page, best first, with their rank over all hits."""
    skip, size = query.window()
    top = found.orderBy(F.desc("score"), id_).limit(skip + size)
    # the window sees no more rows than pages up to this one hold
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), id_)))
    return ranked.filter(F.col("rank") > skip)


def totals(found: DataFrame, query: Query) -> DataFrame:
    """(found, pages)."""
    return found.agg(F.count("*").alias("found")).withColumn("pages", F.ceil(F.col("found") / query.window()[1]))


def facets(rows: DataFrame, fields: list[str], shown: int | None = None) -> DataFrame:
    """(facet, value, n) of filled values; with ``shown`` the most frequent ones of each facet."""
    kinds = dict(rows.dtypes)

    def values(f: str) -> Column:
        own = F.col(f) if kinds[f].startswith("array") else F.array(F.col(f).cast("string"))
        return F.transform(own, lambda v: F.struct(F.lit(f).alias("facet"), v.cast("string").alias("value")))

    each = F.flatten(F.array(*map(values, fields)))
    counted = rows.select(F.explode(each).alias("c")).select("c.*").filter("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))
    if shown is None:
        return counted
    order = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= shown)


def facet_index(rows: DataFrame, id_: str, fields: list[str]) -> DataFrame:
    """(facet, value, block, bits): the rows of each value as bitmaps, one for each block of ids.

    Ids are longs from 0, a row each; their numbers may have gaps. What is written once answers for any set of filters.
    """
    kinds = dict(rows.dtypes)

    def values(f: str) -> Column:
        own = F.col(f) if kinds[f].startswith("array") else F.array(F.col(f).cast("string"))
        return F.transform(F.array_distinct(own), lambda v: F.struct(F.lit(f).alias("facet"), v.cast("string").alias("value")))

    each = rows.select(F.col(id_).cast("long").alias("id"), F.explode(F.flatten(F.array(*(F.coalesce(values(f), F.array().cast("array<struct<facet:string,value:string>>")) for f in fields)))).alias("c"))
    told = each.select("id", "c.*").filter("value is not null and id is not null")
    return told.groupBy("facet", "value", F.bitmap_bucket_number("id").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def facet_counts(index: DataFrame, filters: dict[str, str], fields: list[str] | None = None) -> DataFrame:
    """(facet, value, n) of the rows that pass all filters, from bitmaps alone: no row is read.

    A block's rows that pass are the bits common to its filters' bitmaps; each value's count is that of the
    bits it has in common with these. A block is 4 kB a value, whatever the number of rows.
    """
    wanted = index if fields is None else index.filter(F.col("facet").isin(fields))
    if filters:
        clause = F.lit(False)
        for f, v in filters.items():
            clause = clause | ((F.col("facet") == f) & (F.col("value") == v))
        every = F.aggregate(F.slice("_all", 2, len(filters)), F.get("_all", F.lit(0)), _both)
        chosen = index.filter(clause).groupBy("block").agg(F.collect_list("bits").alias("_all")).filter(F.size("_all") == len(filters)).select("block", every.alias("_pass"))
        wanted = wanted.join(chosen, "block").withColumn("bits", _both(F.col("bits"), F.col("_pass")))
    counted = wanted.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return counted.filter("n > 0")


def _both(a: Column, b: Column) -> Column:
    """The bits that two bitmaps share, eight bytes at a time."""
    at = F.sequence(F.lit(1), F.least(F.octet_length(a), F.octet_length(b)), F.lit(4))
    word = lambda c, i: F.conv(F.hex(F.substring(c, i, F.lit(4))), 16, 10).cast("long")
    words = F.transform(at, lambda i: F.lpad(F.hex(word(a, i).bitwiseAND(word(b, i))), 8, "0"))
    return F.unhex(F.array_join(words, ""))


def toggled(query: Query, facet: str, value: str) -> Query:
    """The same value again clears a facet, another one replaces it; back to the first page."""
    filters = dict(query.filters)
    if filters.get(facet) == value:
        del filters[facet]
    else:
        filters[facet] = value
    return Query(query.text, filters, 1, query.page_size, query.typos, query.prefix)


#: Licenses whose pictures may be shown.
EMBEDDABLE = ["cc0", "cc-by", "cc-by-nc", "cc-by-nc-nd", "cc-by-nc-sa", "non-commercial-educational"]


def render(license_: Column | str, image: Column | str, thumbnail: Column | str) -> Column:
    """Struct (mode, attribution, source): placeholder, link or embed, as the license allows."""
    source = F.coalesce(F.nullif(col(thumbnail), F.lit("")), F.nullif(col(image), F.lit("")))
    lic = F.coalesce(col(license_), F.lit("unknown"))
    mode = F.when((lic == "none") | source.isNull(), "placeholder").when(lic.isin(EMBEDDABLE), "embed").otherwise("link")
    return F.struct(mode.alias("mode"), ((mode == "embed") & (lic != "cc0")).alias("attribution"), F.when(mode == "embed", source).alias("source"))


def card(rows: DataFrame, museums: dict[str, str]) -> DataFrame:
    """What a result card shows: fallbacks for title and site, period only without a better dating."""
    return rows.select(
        "id",
        F.coalesce(F.nullif("title", F.lit("")), F.lit("Untitled")).alias("title"),
        F.coalesce("origin_site_display_name", "origin_site_raw").alias("site"),
        F.when(F.col("dynasty").isNull() & F.col("ruler_display_name").isNull(), F.col("period")).alias("period"),
        F.coalesce(looked_up("source_museum", museums), F.col("source_museum")).alias("museum"),
    )
