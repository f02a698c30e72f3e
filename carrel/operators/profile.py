"""Numbers about a table: fill rates, histograms, unmatched values, fingerprints of content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def fill_rates(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, filled, total, percent), percent rounded down; empty texts don't count."""
    kinds = dict(rows.dtypes)
    is_filled = lambda f: F.col(f).isNotNull() & (F.col(f) != "") if kinds[f] == "string" else F.col(f).isNotNull()
    one = rows.agg(F.count("*").alias("total"), *(F.count_if(is_filled(f)).alias(f"_{i}") for i, f in enumerate(fields)))
    cells = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f"_{i}").alias("filled")) for i, f in enumerate(fields)))).alias("c")
    out = one.select("total", cells).select("c.field", "c.filled", "total")
    return out.withColumn("percent", F.when(F.col("total") > 0, F.floor(100 * F.col("filled") / F.col("total"))))


def histogram(rows: DataFrame, value: Column | str) -> DataFrame:
    c = F.col(value) if isinstance(value, str) else value
    return rows.groupBy(c.alias("value")).agg(F.count("*").alias("n"))


def unmatched(rows: DataFrame, value: str, known: DataFrame, known_value: str) -> DataFrame:
    """(value, n) of filled values that a list lacks, counted."""
    listed = known.select(F.col(known_value).alias("_known")).distinct()
    counted = histogram(rows.filter(F.col(value).isNotNull()), value)
    return counted.join(listed, F.col("value") == F.col("_known"), "left_anti")


def content_hash(*columns: str) -> Column:
    """Hex SHA-256 of a row's fields as JSON, nulls included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def field_names(rows: DataFrame, data: str) -> DataFrame:
    """Distinct names of the top-level fields of JSON documents."""
    return rows.select(F.explode(F.json_object_keys(data)).alias("name")).distinct()


def excluded(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Adds reason: the first rule that puts a row out of scope, null for rows in scope."""
    reason = F.lit(None).cast("string")
    for name, condition in reversed(rules):
        reason = F.when(F.coalesce(condition, F.lit(False)), name).otherwise(reason)
    return rows.withColumn("reason", reason)


def observed(rows: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """(rows, what is measured of them while they are written): their number and other aggregates."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in metrics.items())), seen


def outcomes(rows: DataFrame, error: Column, skipped: Column) -> DataFrame:
    """(stored, skipped, errors) in one pass; a row that failed counts as an error alone."""
    bad, left = F.coalesce(error, F.lit(False)), F.coalesce(skipped, F.lit(False))
    return rows.agg(F.count_if(~bad & ~left).alias("stored"), F.count_if(~bad & left).alias("skipped"), F.count_if(bad).alias("errors"))
