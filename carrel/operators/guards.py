"""Checks that fail loudly, and the same checks as tables of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DataError(ValueError):
    """Data that breaks a rule; the message shows a few of the rows."""


def fail_if_any(bad: DataFrame, what: str, shown: int = 5) -> None:
    """Raises if a table of violations has rows; reads no more of it than it shows."""
    rows = bad.limit(shown).collect()
    if rows:
        raise DataError(f"{what}: " + "; ".join(str(r.asDict(recursive=True)) for r in rows))


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def outside_vocabulary(rows: DataFrame, field: str, allowed: list) -> DataFrame:
    """Filled values outside a closed list, with how many rows hold them."""
    return rows.filter(F.col(field).isNotNull() & ~F.col(field).isin(allowed)).groupBy(field).agg(F.count("*").alias("n"))


def misshapen(rows: DataFrame, field: str, pattern: str) -> DataFrame:
    """Rows whose field isn't of the pattern; null counts as misshapen."""
    return rows.filter(~F.coalesce(F.col(field).rlike(pattern), F.lit(False)))


def orphans(rows: DataFrame, field: str, parents: DataFrame, parent_field: str) -> DataFrame:
    """Rows whose filled reference isn't among the parents."""
    keys = parents.select(F.col(parent_field).alias("_parent")).distinct()
    return rows.filter(F.col(field).isNotNull()).join(keys, F.col(field) == F.col("_parent"), "left_anti")


def outside(rows: DataFrame, field: str, least, most) -> DataFrame:
    return rows.filter(F.col(field).isNotNull() & ~F.col(field).between(least, most))


def outside_box(rows: DataFrame, lon: str, lat: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Points outside (west, south, east, north), with whether they fit with the axes swapped."""
    inside = lambda x, y: x.between(box[0], box[2]) & y.between(box[1], box[3])
    x, y = F.col(lon), F.col(lat)
    return rows.filter(x.isNotNull() & y.isNotNull() & ~inside(x, y)).withColumn("swapped", inside(y, x))


def disagreeing(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    """Rows where two conditions that imply each other differ; null counts as false."""
    no = F.lit(False)
    return rows.filter(F.coalesce(a, no) != F.coalesce(b, no))


def missing_fields(documents: DataFrame, id_: str, data: str, fields: list[str]) -> DataFrame:
    """(id, missing) of JSON documents that lack any of the fields; a field that is null is there."""
    lacking = F.array_except(F.array(*map(F.lit, fields)), F.coalesce(F.json_object_keys(data), F.array().cast("array<string>")))
    return documents.select(F.col(id_).alias("id"), lacking.alias("missing")).filter(F.size("missing") > 0)


def mistyped(claims: DataFrame, types: DataFrame, allowed: DataFrame) -> DataFrame:
    """Claims (subject, predicate, object) whose ends aren't of types that their predicate allows.

    types: (node, type); allowed: (predicate, subject_type, object_type). An end without a type fits nothing.
    """
    told = claims
    for end in ("subject", "object"):
        told = told.join(types.select(F.col("node").alias(end), F.col("type").alias(f"{end}_type")), end, "left")
    return told.join(allowed, ["predicate", "subject_type", "object_type"], "left_anti").select("subject", "predicate", "object", "subject_type", "object_type")


def unsymmetric(pairs: DataFrame, a: str, b: str, tasks: int | None = None) -> DataFrame:
    """Pairs (a, b) without their mirror, each once; a null has none.

    One aggregate by the two ends in order, without a join: a pair and its mirror are one group that knows both ways.
    tasks: over how many the groups are dealt, for tables where few pairs repeat; else pairs are combined before they are shuffled.
    """
    up = F.coalesce(F.col(a) <= F.col(b), F.lit(False))
    down = F.coalesce(F.col(a) >= F.col(b), F.lit(True))
    ends = pairs.select(F.when(up, F.col(a)).otherwise(F.col(b)).alias("_low"), F.when(up, F.col(b)).otherwise(F.col(a)).alias("_high"), up.alias("_up"), down.alias("_down"))
    if tasks:
        ends = ends.repartition(tasks, "_low", "_high")
    ways = ends.groupBy("_low", "_high").agg(F.max("_up").alias("_up"), F.max("_down").alias("_down")).filter("_up <> _down")
    return ways.select(F.when(F.col("_up"), F.col("_low")).otherwise(F.col("_high")).alias(a), F.when(F.col("_up"), F.col("_high")).otherwise(F.col("_low")).alias(b))


def in_several_sections(rows: DataFrame, key: str, section: str) -> DataFrame:
    found = rows.groupBy(key).agg(F.count_distinct(section).alias("sections"))
    return found.filter("sections > 1")


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either table that the other lacks, with multiplicity; empty for equal tables."""
    names = sorted(a.columns)
    return a.select(names).exceptAll(b.select(names)).withColumn("side", F.lit("left")).unionByName(b.select(names).exceptAll(a.select(names)).withColumn("side", F.lit("right")))


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, n) for tables of violations, in one job."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n") for name, df in checks.items()))
