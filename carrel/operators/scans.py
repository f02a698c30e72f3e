"""Scans down a document that no one task holds: ranges, what they leave to the next, then each range by itself.

A document's lines are cut into ranges of ``SPAN`` line numbers. Each range is summed up by a partial aggregate
(its last filled value, its sum), the summaries of a document are scanned in order, a row for each range, and
what a range gets from those before it is added to a window inside it. So a document of any length is
spread over tasks, and no window runs over a whole document's lines.

Cases: null values are passed over; lines of one number stand in any order; a null document is a document; line
numbers are integers, gaps in them cost nothing; columns whose names begin with an underscore and ``scan``
are this module's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 1 << 16


def _with_carry(lines: DataFrame, summary: dict[str, Column], doc: str, order: str, ahead: bool, carry: dict, span: int) -> DataFrame:
    """Adds the columns of ``carry`` (column functions over a window of the ranges before) to lines with _scan_span."""
    told = lines.withColumn("_scan_span", F.floor(F.col(order) / span))
    ranges = told.groupBy(F.col(doc).alias("_scan_doc"), F.col("_scan_span").alias("_scan_at")).agg(*(c.alias(n) for n, c in summary.items()))
    along = F.col("_scan_at").desc() if ahead else F.col("_scan_at").asc()
    before = Window.partitionBy("_scan_doc").orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    carried = ranges.select("_scan_doc", "_scan_at", *(f(n).over(before).alias(f"_scan_{n}") for n, f in carry.items()))
    return told.join(carried, F.col(doc).eqNullSafe(F.col("_scan_doc")) & (F.col("_scan_span") == F.col("_scan_at")), "left")


def last_filled(lines: DataFrame, value: Column, name: str, doc: str = "doc", order: str = "line_no", ahead: bool = False, strictly: bool = False, span: int = SPAN) -> DataFrame:
    """Adds the last value that isn't null at or above each line; ``ahead``: the next one at or below; strictly: not the line's own."""
    own = lines.withColumn("_scan_value", value)
    pick = F.min_by if ahead else F.max_by
    edge = pick("_scan_value", F.when(F.col("_scan_value").isNotNull(), F.col(order)))
    told = _with_carry(own, {"edge": edge}, doc, order, ahead, {"edge": lambda c: F.last(c, ignorenulls=True)}, span)
    along = F.col(order).desc() if ahead else F.col(order).asc()
    inside = Window.partitionBy(doc, "_scan_span").orderBy(along).rowsBetween(Window.unboundedPreceding, -1 if strictly else 0)
    found = F.coalesce(F.last("_scan_value", ignorenulls=True).over(inside), F.col("_scan_edge"))
    return told.withColumn("_scan_found", found).select(*(c for c in lines.columns if c != name), F.col("_scan_found").alias(name))


def running_sums(lines: DataFrame, values: dict[str, Column], doc: str = "doc", order: str = "line_no", span: int = SPAN) -> DataFrame:
    """Adds the sum of each value over the lines down to each one, itself included."""
    own = lines.withColumns({f"_scan_value_{n}": F.coalesce(v, F.lit(0)).cast("long") for n, v in values.items()})
    told = _with_carry(own, {n: F.sum(f"_scan_value_{n}") for n in values}, doc, order, False, {n: F.sum for n in values}, span)
    inside = Window.partitionBy(doc, "_scan_span").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"_scan_sum_{n}": F.sum(f"_scan_value_{n}").over(inside) + F.coalesce(F.col(f"_scan_{n}"), F.lit(0)) for n in values}
    return told.withColumns(sums).select(*(c for c in lines.columns if c not in values), *(F.col(f"_scan_sum_{n}").alias(n) for n in values))
