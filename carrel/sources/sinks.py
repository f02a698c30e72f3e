"""Sinks: upserts, versioned publishing, null-free documents, deterministic JSON lines, audit logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.operators.guards import fail_if_any


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those of equal key; a new key twice fails."""
    fail_if_any(new.groupBy(*key).count().filter("count > 1"), "an upsert holds a key twice")
    return existing.join(new.select(*key), key, "left_anti").unionByName(new)


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last by ``order``.

    An aggregate and not a window: tasks keep one row a key before the shuffle, so a key that holds
    a third of all rows costs no more than any other.
    """
    rest = [c for c in rows.columns if c not in key]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return best.select(*key, *(F.col("_last")[c].alias(c) for c in rest)).select(*rows.columns)


def document(*columns: str) -> Column:
    """A row as JSON without its nulls."""
    return F.to_json(F.struct(*columns))


def publish(rows: DataFrame, folder: str, version: int | str, view: str) -> int:
    """Writes a new version beside the old ones, checks it, and then points at it.

    The pointer is a row in a table of its own beside the versions, so every session and every later
    run sees the same one; readers see the old version whole or the new one whole. The view of this
    session follows. Returns the rows written.
    """
    spark, path = rows.sparkSession, f"{folder}/{view}_{version}"
    rows.write.mode("errorifexists").parquet(path)
    written = spark.read.parquet(path)
    fail_if_any(written.agg(F.count("*").alias("n")).filter("n = 0"), "an empty version is not published")
    pointer = spark.range(1).select(F.lit(str(version)).alias("version"), F.lit(path).alias("path"), F.current_timestamp().alias("at"))
    pointer.write.mode("append").parquet(f"{folder}/{view}__pointers")
    written.createOrReplaceTempView(view)
    return written.count()


def published(spark: SparkSession, folder: str, view: str) -> DataFrame:
    """The version that was published last, in whatever session."""
    last = spark.read.parquet(f"{folder}/{view}__pointers").agg(F.max_by("path", "at")).first()[0]
    return spark.read.parquet(last)


def outdated(spark: SparkSession, folder: str, view: str) -> DataFrame:
    """(version, path) of published versions that a later one replaced, which may be removed."""
    pointers = spark.read.parquet(f"{folder}/{view}__pointers")
    last = pointers.agg(F.max_by("path", "at").alias("_last"))
    return pointers.join(last, F.col("path") == F.col("_last"), "left_anti").select("version", "path")


def write_documents(rows: DataFrame, path: str, key: str) -> None:
    """JSON lines of null-free documents; a missing or repeated key fails before anything is written."""
    fail_if_any(rows.filter(F.col(key).isNull()), "a document without a key")
    fail_if_any(rows.groupBy(key).count().filter("count > 1"), "a document key stands twice")
    rows.select(document(*rows.columns).alias("value")).write.text(path)


def write_sorted_json(rows: DataFrame, path: str, order: list[Column | str]) -> None:
    """JSON lines with sorted field names and explicit nulls, in a total order over all part files."""
    names = sorted(rows.columns)
    line = F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("value")
    rows.repartitionByRange(*order).sortWithinPartitions(*order).select(line).write.mode("overwrite").text(path)


def section_replaced(log: DataFrame, marker: str, section: DataFrame) -> DataFrame:
    """(line_no, line) of a log cut at the first line that is the marker, with the section's lines after it.

    Replacing it again gives the same lines.
    """
    first = log.filter(F.col("line") == marker).agg(F.min("line_no").alias("_first"))
    kept = log.join(F.broadcast(first)).filter("_first is null or line_no < _first").select("line_no", "line")  # one row
    last = kept.agg(F.coalesce(F.max("line_no"), F.lit(0)).cast("long").alias("_last"))
    added = section.select((F.col("line_no") + 1).alias("_n"), "line").unionByName(last.select(F.lit(1).cast("long").alias("_n"), F.lit(marker).alias("line")))
    numbered = added.join(F.broadcast(last)).select((F.col("_last") + F.col("_n")).alias("line_no"), "line")  # one row
    return kept.select(F.col("line_no").cast("long").alias("line_no"), "line").unionByName(numbered)


def audit(before: DataFrame, after: DataFrame, key: list[str], fields: list[str], stage: str) -> DataFrame:
    """(stage, key..., field, before, after) for each cell that a stage changed."""
    def long(df: DataFrame, name: str) -> DataFrame:
        cells = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.to_json(F.struct(F.col(f).alias("v")), {"ignoreNullFields": "false"}).alias(name)) for f in fields))).alias("c")
        return df.select(*key, cells).select(*key, "c.field", f"c.{name}")

    both = long(before, "before").join(long(after, "after"), [*key, "field"], "full_outer")
    value = lambda c: F.get_json_object(c, "$.v")
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select(F.lit(stage).alias("stage"), *key, "field", value("before").alias("before"), value("after").alias("after"))
