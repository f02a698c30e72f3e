"""Sort keys parsed from ids, and places in an order over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrel.functions.text import col, found, strip
from carrel.sources.staging import stage


def parsed(id_: Column | str, pattern: str, numeric: list[bool]) -> list[Column]:
    """One column for each group of a pattern, numbers as numbers; an id that doesn't fit fails."""
    c = col(id_)
    bad = F.when(~c.rlike(pattern), F.raise_error(F.concat(F.lit("a malformed id: "), c)).cast("string")).otherwise(c)
    return [found(bad, pattern, i).cast("long") if number else F.coalesce(found(bad, pattern, i), F.lit("")) for i, number in enumerate(numeric, 1)]


def ranked(c: Column | str, order: list[str], unknown: int = 9999) -> Column:
    """The place of a word in a list, a late one for others."""
    table = F.create_map(*(F.lit(x) for pair in zip(order, range(len(order)), strict=True) for x in pair))
    return F.coalesce(table[col(c)], F.lit(unknown))


def natural(c: Column | str) -> Column:
    """Struct (text before the last number, that number): NATION_9 stands before NATION_10."""
    return F.struct(F.regexp_replace(col(c), r"\d+\D*$", "").alias("head"), found(c, r"(\d+)\D*$").cast("long").alias("number"), col(c).alias("whole"))


def binned(name: Column | str, last: Column, damaged: str = r"^\s*[\[\.…]") -> list[Column]:
    """Unplaced rows last, damaged names after whole ones, then by name in lower case."""
    return [F.coalesce(last, F.lit(False)).cast("int"), F.coalesce(col(name).rlike(damaged), F.lit(True)).cast("int"), F.lower(strip(name))]


def placed(rows: DataFrame, order: list[Column | str], name: str = "place") -> DataFrame:
    """Adds each row's place (from 1) in an order over the whole table, without bringing it into one task.

    Rows are dealt by ranges of the order and written; each range is numbered by itself, from the number of rows of the
    ranges before it on. The one window over everything sees a row for each range. Rows that are equal in
    the whole order are of one range and stand in any order.
    """
    keys = [f"_order{i}" for i in range(len(order))]
    keyed = rows.withColumns({k: col(o) for k, o in zip(keys, order, strict=True)})
    dealt = stage(keyed.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "placed")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return dealt.withColumn("_inside", inside).join(before, "_range").withColumn(name, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before", *keys)
