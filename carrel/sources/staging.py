"""Intermediate tables in the folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 1 << 18  #: that a task brings together, about
BATCH_BYTES = 1 << 22  #: of rows that a Python worker gets at once where they hold long texts, about
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set and Spark is local, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set, and other machines can't see a temporary folder of this one")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="carrel-shared-")
    return _own[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet into the shared folder and reads it back.

    This cuts the lineage durably: a lost executor costs no more than a re-read.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile gives Python workers Arrow batches of about BATCH_BYTES, however long the texts.

    Spark's own limit is 64 MB, of which a task holds two batches in Python and one, in doubled buffers, in the executor.
    """
    before = spark.conf.get(_BATCHES)
    if int(before.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(_BATCHES, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCHES, before)


def tasks_for(rows: DataFrame, most: int | None = None) -> int:
    """Into how many tasks of about ``most`` (TASK_ROWS) to deal so many rows, so that what one holds doesn't grow with the table.

    The rows are counted, which for a Parquet table takes no more than the footers of its files.
    """
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (most or TASK_ROWS)))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder of Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
