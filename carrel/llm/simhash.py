"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all fingerprints within half the radius of it (65 for radius 2).
Two fingerprints within the radius share at least one emitted variant, so a shuffle on the variant
brings every linked pair together; a group holds at most as many fingerprints as a ball, however
many documents carry them. Colliding pairs are verified by their differing bits.

Cases: a null text counts as empty; a text without words has fingerprint zero and is linked like
any other; repeated rows give repeated result rows; a null doc_id keeps its row, takes part in
links, and is never a component_id unless every linked row lacks an id; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.llm.components import connected
from carrel.sources.staging import stage

BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text as a signed integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64)
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), BLOCK):
        part = hashes[lo : lo + BLOCK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def _ball(fp: Column, radius: int) -> Column:
    """All values at most ``radius`` (0 or 1) bits from fp."""
    if radius == 0:
        return F.array(fp)
    return F.array(fp, *(fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64)))


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between different fingerprints of column fp that connect all within ``radius`` (1 or 2).

    Within a variant's group every pair is within twice the half radius, so for radius 2 links from its smallest
    fingerprint to each other one connect the same fingerprints as all pairs do. For radius 1 only the
    variant itself is near enough to all of its group, so links go from it, where it is a fingerprint.
    """
    if radius not in (1, 2):
        raise ValueError("the radius is 1 or 2")
    emitted = fps.select("fp", F.explode(_ball(F.col("fp"), 1)).alias("variant"))
    groups = emitted.groupBy("variant").agg(F.min("fp").alias("a"), F.max("fp").alias("top"), F.collect_set("fp").alias("members")).filter("a < top")
    if radius == 1:
        groups = groups.filter(F.array_contains("members", F.col("variant"))).withColumn("a", F.col("variant"))
    pairs = groups.select("a", F.explode("members").alias("b")).filter(F.col("a") != F.col("b"))
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``.

    component_id is the smallest doc_id reachable through links, itself included.
    """
    fps = stage(fingerprints(docs, shingle), "simhash")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    members = connected(links(classes.repartition(tasks, "fp"), radius))
    owned = classes.join(members.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))
    smallest = owned.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = stage(owned.join(smallest, "component").select("fp", "component_id"), "simhash-named")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")
