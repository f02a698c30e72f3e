"""Joins of overlapping intervals without comparing all pairs.

Each interval is at home on the level of bins whose width fits its length, where it touches few
bins, and visits the levels above. Bins are equi-joined, home with home and home with visitors, and
a pair counts in the one bin where its overlap begins. Two short intervals never meet in a wide
bin, so what is compared is in proportion to the rows and to the pairs that overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.operators.guards import fail_if_any

_FACTOR = 16  #: bins of a level are so many times as wide as those below


def _level(length: Column, width: int, levels: int) -> Column:
    """The first level at which an interval touches few bins."""
    out = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        out = F.when(length <= width * _FACTOR ** (k + 1), F.lit(k)).otherwise(out)
    return out


def _bins(start: Column, end: Column, width: Column) -> Column:
    """Numbers of the bins that [start, end) touches."""
    return F.sequence(F.floor(start / width).cast("long"), F.floor((end - 1) / width).cast("long"))


def compared(left: DataFrame, right: DataFrame, by: list[str], width: int = 64, levels: int = 5) -> DataFrame:
    """Pairs of rows that share a bin, a row for each such bin (_w wide, numbered _bin)."""
    def shaped(df: DataFrame, side: str) -> DataFrame:
        size = F.col("end") - F.col("start")
        return df.select(*by, F.col("id").alias(f"{side}_id"), F.col("start").cast("long").alias(f"{side}_s"), F.col("end").cast("long").alias(f"{side}_e"), _level(size, width, levels).alias(f"{side}_k"))

    def binned(df: DataFrame, side: str) -> DataFrame:
        wide = F.lit(width) * F.pow(F.lit(_FACTOR), F.col("_k")).cast("long")
        return df.withColumn("_w", wide).withColumn("_bin", F.explode(_bins(F.col(f"{side}_s"), F.col(f"{side}_e"), F.col("_w"))))

    def at_home(df: DataFrame, side: str) -> DataFrame:
        return binned(df.withColumn("_k", F.col(f"{side}_k")), side)

    def visiting(df: DataFrame, side: str) -> DataFrame:
        own = F.col(f"{side}_k")
        return binned(df.filter(own < levels - 1).withColumn("_k", F.explode(F.sequence(own + 1, F.lit(levels - 1)))), side)

    a, b, on = shaped(left, "left"), shaped(right, "right"), [*by, "_k", "_w", "_bin"]
    pairs = at_home(a, "left").join(at_home(b, "right").unionByName(visiting(b, "right")), on)
    pairs = pairs.unionByName(visiting(a, "left").join(at_home(b, "right"), on))
    return pairs


def overlapping(left: DataFrame, right: DataFrame, by: list[str], width: int = 64, levels: int = 5) -> DataFrame:
    """Pairs of rows with equal ``by`` whose [start, end) of whole numbers overlap; touching is none.

    left and right have columns id, start, end and ``by``. Returns by..., left_id, right_id.
    """
    begins = F.greatest("left_s", "right_s")
    hit = (begins < F.least("left_e", "right_e")) & (F.floor(begins / F.col("_w")) == F.col("_bin"))
    return compared(left, right, by, width, levels).filter(hit).select(*by, "left_id", "right_id")


def concurrent(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by..., id, partners): the sorted ids whose interval overlaps a row's, itself excluded.

    An end may be corrected: ``corrected_end`` wins where the column is there and filled. A row that
    doesn't end after its start fails.
    """
    end = F.coalesce("corrected_end", "end") if "corrected_end" in rows.columns else F.col("end")
    own = rows.withColumn("end", end)
    fail_if_any(own.filter("start >= end"), "an interval that doesn't end after its start")
    pairs = overlapping(own, own, by).filter("left_id <> right_id")
    partners = pairs.groupBy(*by, F.col("left_id").alias("id")).agg(F.array_sort(F.collect_set("right_id")).alias("partners"))
    return own.select(*by, "id").join(partners, [*by, "id"], "left").withColumn("partners", F.coalesce("partners", F.array().cast("array<" + own.schema["id"].dataType.simpleString() + ">")))
