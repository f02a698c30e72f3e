"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

A source's target is its weighted share of the mix, at most ``max_epochs`` times its size; what is
over the clamp is dealt again by weight among the sources below theirs, until none is above. The
documents of a source then repeat as often as whole targets ask for; the rest of the target is
filled in an order seeded by the hash of doc_id and text: documents count fully while they fit, and the one
document on the boundary counts for the words that are left, so taken words miss the target by
less than one word.

The running total over a source is two sums: within one of 4096 hash buckets, and over a source's
bucket totals. No source, however large, is brought together in one task. The windows over bucket totals and
over sources see one row for each bucket of a source (4096 at most) and one for each source.

Cases: a null or wordless text has size zero and is never taken; null is a source of its own, after
all others; a null doc_id is ordered as an empty one; repeated rows are separate documents, which
can't be told apart; an empty table gives an empty result; further columns are ignored
by ``mix`` and kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carrel.sources.staging import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "carrel-mix"
BUCKET_DIGITS = 3  #: hexadecimal digits of the hash that name a bucket


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to (source_size, weight), one row a source.

    Each round clamps the sources whose weighted part of what is left exceeds their cap and deals
    the rest again; the driver holds a few totals only.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = float(share) * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    clamped = -1
    while True:
        over = cap < F.col("weight") * F.lit(level) if clamped >= 0 else F.lit(False)
        held, free, n = sources.agg(F.sum(F.when(over, cap).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight"))), F.count_if(over)).first()
        if not free or n == clamped:
            break
        clamped, level = n, max(0.0, total - held) / free
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if free else cap)


def _keys(seed: str) -> list[Column]:
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))
    source = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    return [source.alias("_source"), F.substring(key, 1, BUCKET_DIGITS).alias("_bucket"), key.alias("_key")]


def _plan(sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int) -> DataFrame:
    """(_source, _bucket, _before, source_size, target): one row for each bucket of a source."""
    buckets = stage(sized.groupBy("source", "_source", "_bucket").agg(F.sum("size").alias("_size")), "mix-buckets")
    sources = buckets.groupBy("source", "_source").agg(F.sum("_size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    targets = water_fill(stage(sources.withColumn("weight", weight), "mix-sources"), share, max_epochs)
    before = W.partitionBy("_source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = buckets.select("_source", "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return placed.join(targets.select("_source", "source_size", "target"), "_source")


def _taken(docs: DataFrame, weights: tuple[float, ...], share: float, max_epochs: int, seed: str, keep: list[str]) -> DataFrame:
    sized = docs.withColumns({"size": n_words()}).select("*", *_keys(seed))
    plan = _plan(sized, weights, share, max_epochs)
    joined = sized.select(*keep, "size", "_source", "_bucket", "_key").join(plan, ["_source", "_bucket"])
    inside = W.partitionBy("_source", "_bucket").orderBy("_key").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    whole = F.floor(F.col("target") / F.col("source_size"))
    left = F.floor(F.col("target")) - whole * F.col("source_size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), left - start))
    return joined.withColumn("taken", F.when(F.col("source_size") > 0, whole * F.col("size") + extra).otherwise(F.lit(0)).cast("long"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source")
    return _taken(rows, weights, share, max_epochs, seed, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself, in the columns of ``docs``: each row as often as it is taken.

    The boundary document of a source appears once more with the first words that are taken, joined
    by single spaces; a column n_chars then counts these.
    """
    columns = docs.columns
    named = docs.select(F.struct(*columns).alias("_row"), "doc_id", "text", "source")
    kept = _taken(named, weights, share, max_epochs, seed, ["_row", "text"]).filter("taken > 0")
    rows = kept.select("_row", "text", "size", "taken", F.explode(F.sequence(F.lit(0), F.floor((F.col("taken") - 1) / F.col("size")))).alias("_copy"))
    words = F.least(F.col("size"), F.col("taken") - F.col("_copy") * F.col("size")).cast("int")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words))
    out = rows.select("_row", F.when(words < F.col("size"), cut).otherwise(F.col("text")).alias("_text"), (words < F.col("size")).alias("_cut"))
    own = {"text": F.col("_text"), "n_chars": F.when(F.col("_cut"), F.length("_text").cast("long")).otherwise(F.col("_row.n_chars")) if "n_chars" in columns else None}
    return out.select(*(own[c].alias(c) if own.get(c) is not None else F.col(f"_row.`{c}`").alias(c) for c in columns))
