"""An extension: counts and newest rows of an event stream, with late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.sources.sinks import latest


def windowed_counts(stream: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(window_start, kind, n) of tumbling windows; rows later than ``late`` are dropped."""
    counted = stream.withWatermark(time, late).groupBy(F.window(time, width), kind).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), kind, "n")


def write_newest(stream: DataFrame, key: list[str], order: list[str], path: str, checkpoint: str):
    """Each batch's newest row of a key goes to a folder of its own; a batch that runs again replaces it."""
    def put(batch: DataFrame, number: int) -> None:
        latest(batch, key, order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
