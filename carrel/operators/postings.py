"""A stored search index: words with their misspellings, and postings in blocks that a search can skip.

``write`` makes three tables once. ``terms`` has each word, in order, so a prefix is a range of it.
``variants`` has each word under all that deleting up to ``edits`` letters leaves of it: two words within that
many edits share such a variant, so a misspelt word is found by looking its own variants up. ``postings`` has
blocks of one word's rows in one span of ids: offsets from the span's start, the fields that hold the
word as bits, and the union of these. It is dealt over folders by the word, in order inside, so a
search reads the folders of its words and skips the rest by Parquet's statistics.

``found`` reads the blocks of the words alone. Spans in which a word of the query has no block are
dropped before any block is opened. ``best`` also bounds what a span's rows can score by
the fields of its blocks: it opens the spans of the highest bounds first, and of all others only those whose bound
reaches the k-th score.

Cases: ids are longs, and rows of one id count as one; a null or empty field has no words; a query without words
finds nothing (of no text at all ``search.filtered`` answers); more edits than the index was made for are
refused; an empty table gives an index without rows.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions.text import tokens
from carrel.operators.search import Query

BLOCK_ROWS = 4096  #: ids of a span, about, as many as a block holds at most where ids are evenly spread
SHARD_ROWS = 1 << 22  #: postings of a folder, about
WORDS_SENT = 1024  #: words that are looked up by name; more are joined
OPENED_FIRST = 64  #: spans
_SCHEMAS = {
    "terms": "token string, n long, held int",
    "variants": "token string, variant string",
    "postings": "token string, span long, n int, held int, offsets array<int>, masks array<int>, shard int",
}


@dataclass(frozen=True)
class Index:
    path: str
    fields: dict[str, float]  #: weight of each field, in the order of its bit
    edits: int
    shards: int
    bits: int  #: of an id that are its offset in a span

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.schema(_SCHEMAS[table]).parquet(f"{self.path}/{table}")

    def weight(self, mask: Column) -> Column:
        parts = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(float(w))).otherwise(F.lit(0.0)) for i, w in enumerate(self.fields.values())]
        return sum(parts[1:], parts[0])


def _shard(token: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(shards)).cast("int")


def _deletions(word: Column) -> Column:
    """What deleting one letter leaves, or the word itself if it has none."""
    return F.when(F.length(word) == 0, F.array(word)).otherwise(F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word)))))


def _variants(word: Column, edits: int) -> Column:
    found = step = F.array(word)
    for _ in range(edits):
        step = F.array_distinct(F.flatten(F.transform(step, _deletions)))
        found = F.array_union(found, step)
    return found


def variants_of(word: str, edits: int) -> list[str]:
    """The same of a query's word."""
    return sorted({"".join(c for i, c in enumerate(word) if i not in gone) for n in range(min(edits, len(word)) + 1) for gone in combinations(range(len(word)), n)})


def write(rows: DataFrame, id_: str, fields: dict[str, float], path: str, edits: int = 1) -> Index:
    """Indexes the words of ``fields`` under ``path``; rows are read twice, once for the range of their ids."""
    ids = rows.agg(F.count("*"), F.min(id_), F.max(id_)).first()
    spread = (ids[2] - ids[1] + 1) / ids[0] if ids[0] and ids[1] is not None else 1
    bits = min(30, max(0, math.ceil(math.log2(max(1, BLOCK_ROWS * spread)))))
    own = [F.coalesce(F.array_distinct(tokens(f)), F.array().cast("array<string>")) for f in fields]
    held = [f"_f{i}" for i in range(len(fields))]
    split = rows.filter(F.col(id_).isNotNull()).select(F.col(id_).cast("long").alias("id"), *(c.alias(n) for c, n in zip(own, held, strict=True)))
    if len(held) == 1:
        # every word of a row is in its only field: looking each up among all of them takes the square of their number
        each, mask = split.select("id", F.explode(held[0]).alias("token")), F.lit(1)
    else:
        each = split.select("id", *held, F.explode(F.array_distinct(F.flatten(F.array(*held)))).alias("token"))
        mask = sum((F.array_contains(n, F.col("token")).cast("int") * F.lit(1 << i) for i, n in enumerate(held)), F.lit(0))
    posted = each.select("token", F.shiftright("id", bits).alias("span"), F.col("id").bitwiseAND(F.lit((1 << bits) - 1)).cast("int").alias("offset"), mask.alias("mask"))
    # a word that every row holds is dealt over the spans of ids
    blocks = posted.groupBy("token", "span").agg(F.array_sort(F.collect_list(F.struct("offset", "mask"))).alias("p"), F.bit_or("mask").alias("held"))
    shards = 1
    if ids[0]:
        shards = max(1, min(4096, -(-ids[0] * len(fields) * 16 // SHARD_ROWS)))
    made = blocks.select("token", "span", F.size("p").cast("int").alias("n"), "held", F.col("p.offset").alias("offsets"), F.col("p.mask").alias("masks"), _shard(F.col("token"), shards).alias("shard"))
    made.repartition("shard", F.shiftright(F.xxhash64("span"), 61)).sortWithinPartitions("shard", "token", "span").write.partitionBy("shard").parquet(f"{path}/postings")
    spark = rows.sparkSession
    index = Index(path, dict(fields), edits, shards, bits)
    words = index.read(spark, "postings").groupBy("token").agg(F.sum("n").alias("n"), F.bit_or("held").alias("held"))
    words.repartitionByRange("token").sortWithinPartitions("token").write.parquet(f"{path}/terms")
    near = index.read(spark, "terms").select("token", F.explode(_variants(F.col("token"), edits)).alias("variant"))
    near.repartitionByRange("variant").sortWithinPartitions("variant").write.parquet(f"{path}/variants")
    spark.createDataFrame([(json.dumps([list(fields.items()), edits, shards, bits]),)], "index string").coalesce(1).write.parquet(f"{path}/about")
    return index


def opened(spark: SparkSession, path: str) -> Index:
    """An index that was written before."""
    fields, edits, shards, bits = json.loads(spark.read.parquet(f"{path}/about").first()[0])
    return Index(path, dict(map(tuple, fields)), edits, shards, bits)


def matching(spark: SparkSession, index: Index, query: Query) -> DataFrame:
    """(word, token): the words of the index that fit each word of the query, by its number.

    Within ``query.typos`` edits; the last word also as the beginning of a longer one, if the query says so.
    """
    if query.typos > index.edits:
        raise ValueError(f"the index is made for {index.edits} edits, not for {query.typos}")
    found = spark.createDataFrame([], "word int, token string")
    words = query.words()
    for i, word in enumerate(words):
        number = F.lit(i).alias("word")
        if query.typos:
            near = index.read(spark, "variants").filter(F.col("variant").isin(variants_of(word, query.typos)))
            found = found.unionByName(near.filter(F.levenshtein("token", F.lit(word), query.typos) >= 0).select(number, "token"))
        else:
            found = found.unionByName(index.read(spark, "terms").filter(F.col("token") == word).select(number, "token"))
        if query.prefix and i == len(words) - 1:
            found = found.unionByName(index.read(spark, "terms").filter(F.col("token").startswith(word)).select(number, "token"))
    return found.distinct()


def _blocks(spark: SparkSession, index: Index, query: Query) -> DataFrame:
    """(word, span, n, held, offsets, masks): the blocks of the query's words."""
    told = matching(spark, index, query)
    few = told.limit(WORDS_SENT + 1).collect()
    blocks = index.read(spark, "postings")
    if len(few) <= WORDS_SENT:
        names = sorted({r.token for r in few})
        told = spark.createDataFrame([tuple(r) for r in few], told.schema)
        if names:
            shards = [r[0] for r in spark.createDataFrame([(n,) for n in names], "token string").select(_shard(F.col("token"), index.shards)).distinct().collect()]
            blocks = blocks.filter(F.col("shard").isin(shards) & F.col("token").isin(names))
    return blocks.join(told, "token")


def _whole(blocks: DataFrame, n_words: int) -> DataFrame:
    """(span, held): spans in which each word has a block; held: the fields of each."""
    masks = F.array(*(F.coalesce(F.bit_or(F.when(F.col("word") == i, F.col("held"))), F.lit(0)) for i in range(n_words)))
    return blocks.groupBy("span").agg(masks.alias("held")).filter(~F.array_contains("held", 0))


def _scored(index: Index, blocks: DataFrame, n_words: int) -> DataFrame:
    """(id, score) of the rows that hold every word."""
    rows = blocks.select("word", "span", F.explode(F.arrays_zip("offsets", "masks")).alias("p"))
    id_ = (F.shiftleft("span", index.bits) + F.col("p.offsets")).alias("id")
    each = rows.select("word", id_, F.col("p.masks").alias("mask")).groupBy("id").agg(*(F.bit_or(F.when(F.col("word") == i, F.col("mask"))).alias(f"_m{i}") for i in range(n_words)))
    every, score = F.lit(True), F.lit(0.0)
    for i in range(n_words):
        every, score = every & F.col(f"_m{i}").isNotNull(), score + index.weight(F.col(f"_m{i}"))
    return each.filter(every).select("id", score.alias("score"))


def found(spark: SparkSession, index: Index, query: Query) -> DataFrame:
    """(id, score) of all rows that hold every word of the query; scores as ``search.hits`` has them."""
    n = len(query.words())
    if not n:
        return spark.createDataFrame([], "id long, score double")
    blocks = _blocks(spark, index, query)
    if n > 1:
        blocks = blocks.join(_whole(blocks, n).select("span"), "span", "left_semi")
    return _scored(index, blocks, n)


def best(spark: SparkSession, index: Index, query: Query, k: int) -> DataFrame:
    """The k rows (id, score) of the highest scores, of equal ones those of the smallest ids."""
    n = len(query.words())
    if not n:
        return spark.createDataFrame([], "id long, score double")
    blocks = _blocks(spark, index, query)
    bound = F.aggregate("held", F.lit(0.0), lambda s, m: s + index.weight(m))
    spans = _whole(blocks, n).select("span", bound.alias("bound"))
    first = [r.span for r in spans.orderBy(F.desc("bound"), "span").limit(max(OPENED_FIRST, -(-k // BLOCK_ROWS))).collect()]
    order = [F.desc("score"), F.col("id")]
    top = _scored(index, blocks.filter(F.col("span").isin(first)), n).orderBy(*order).limit(k).collect()
    high = spark.createDataFrame([tuple(r) for r in top], "id long, score double")
    rest = spans.filter(~F.col("span").isin(first))
    if len(top) == k:
        rest = rest.filter(F.col("bound") >= top[-1].score)
    more = _scored(index, blocks.join(rest.select("span"), "span", "left_semi"), n)
    return high.unionByName(more).orderBy(*order).limit(k)
