"""Benchmark decontamination: MinHash containment search over size partitions of the test items.

An item counts as leaked into a document if the document holds at least a threshold (0.8) of the
item's distinct shingles of five words, A-Z lower-cased; an item of fewer words has one shingle,
all its words, which a document holds where they stand in a row.

The items are partitioned by size (powers of two of their shingle count). The MinHash sketch of an
item is its n smallest shingle hashes, n being the partition's: the most shingles that an item of
this partition can lack at the threshold, plus one. A document at or over the threshold therefore
holds a sketch hash of the item, however long it is, and the search loses no pair. Documents that
hold one are candidates, which exact containment of the shingles verifies.

The item index is sent to all tasks only while its items number at most ``broadcast_items`` and
their texts hold at most ``broadcast_bytes``; beyond that, document shingles and sketches meet in a
shuffle, and the texts of the pairs that met are compared.

Cases: a null or wordless item leaks nowhere, a null or wordless document holds none; repeated
documents and items give one row for each distinct pair of ids; items that share an item_id count
as one text each; null ids are kept as values; empty tables give an empty result; further columns
are ignored. ``clean`` judges rows by themselves: a clean row stays whatever its doc_id, and also if
another row has the same or none either.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.llm.words import chunks
from carrel.sources.staging import stage

SHINGLE = 5
THRESHOLD = 0.8
BROADCAST_ITEMS = 20_000
BROADCAST_BYTES = 16 << 20

_FOUND = "doc_id long, item long, n_shared long"


def needed(n: int, threshold: float) -> int:
    """The least number of n shingles that is at least the threshold's share of them."""
    return max(1, math.ceil(threshold * n - 1e-9))


def sketch_size(n: int, threshold: float) -> int:
    """Sketch length of the size partition of an item with n shingles."""
    top = 1 << (n - 1).bit_length()
    return min(n, top - needed(top, threshold) + 1)


def item_shingles(text: str | None, k: int = SHINGLE) -> tuple[int, set[int]]:
    """(words of a shingle, hashes of the distinct shingles) of an item."""
    for chunk in chunks(pa.array([text], pa.string())):
        words = len(chunk.start)
        if words:
            size = min(k, words)
            return size, set(chunk.windows(chunk.hashes(lower=True), size)[1].tolist())
    return 0, set()


def _grams(text: str | None, size: int) -> set[int]:
    """Hashes of the distinct runs of so many words of a text."""
    found: set[int] = set()
    for chunk in chunks(pa.array([text], pa.string())):
        found.update(chunk.windows(chunk.hashes(lower=True), size)[1].tolist())
    return found


class Index:
    """Sketch hashes to items, and all shingles of each item."""

    def __init__(self, items: list[tuple[int, str | None]], k: int, threshold: float):
        self.ids, self.sizes, self.least, pairs, self.all = [], [], [], [], []
        for number, (_, text) in enumerate(items):
            size, hashes = item_shingles(text, k)
            if hashes:
                ordered = np.sort(np.fromiter(hashes, np.uint64, len(hashes)))
                pairs.append((size, number, ordered[: sketch_size(len(ordered), threshold)]))
                self.all.append((size, number, ordered))
        self.by_size: dict[int, tuple] = {}
        for size in sorted({p[0] for p in pairs}):
            chosen = [p for p in pairs if p[0] == size]
            hashes = np.concatenate([p[2] for p in chosen])
            owner = np.concatenate([np.full(len(p[2]), p[1]) for p in chosen])
            order = np.argsort(hashes, kind="stable")
            self.by_size[size] = (hashes[order], owner[order])
        self.full = {number: ordered for _, number, ordered in self.all}
        self.least = {number: needed(len(ordered), threshold) for number, ordered in self.full.items()}


def _search(index: Index, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item number, shared shingles) for the texts of a batch."""
    for chunk in chunks(texts):
        hashed = chunk.hashes(lower=True)
        for size, (sketch, owner) in index.by_size.items():
            first, grams = chunk.windows(hashed, size)
            if not len(grams):
                continue
            at = np.searchsorted(sketch, grams)
            hit = np.flatnonzero(sketch[np.minimum(at, len(sketch) - 1)] == grams)
            if not len(hit):
                continue
            docs = np.searchsorted(chunk.bounds, first[hit], "right") - 1
            lo, hi = at[hit], np.searchsorted(sketch, grams[hit], "right")
            candidates: dict[int, set[int]] = {}
            for doc, a, b in zip(docs.tolist(), lo.tolist(), hi.tolist(), strict=True):
                candidates.setdefault(doc, set()).update(owner[a:b].tolist())
            edges = np.searchsorted(first, chunk.bounds)
            for doc, items in candidates.items():
                own = np.unique(grams[edges[doc] : edges[doc + 1]])
                for item in items:
                    full = index.full[item]
                    place = np.minimum(np.searchsorted(own, full), len(own) - 1)
                    shared = int((own[place] == full).sum())
                    if shared >= index.least[item]:
                        yield chunk.first + doc, item, shared


def _by_broadcast(docs: DataFrame, items: list[tuple[int, str | None]], k: int, threshold: float) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(Index(items, k, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_search(held.value, batch.column(1)))
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())], names=["doc_id", "item", "n_shared"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _FOUND)


def _shingled(rows: DataFrame, key: str, sizes: list[int] | None, k: int) -> DataFrame:
    """(key, size, gram): distinct shingle hashes of each row; sizes None: of the row's own size."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                hashed = chunk.hashes(lower=True)
                count = np.diff(chunk.bounds)
                for size in sizes or range(1, k + 1):
                    first, grams = chunk.windows(hashed, size)
                    doc = np.searchsorted(chunk.bounds, first, "right") - 1
                    if sizes is None:
                        own = np.minimum(count, k)[doc] == size
                        doc, grams = doc[own], grams[own]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + chunk.first)), pa.array(np.full(len(doc), size, np.int32)), pa.array(grams.view(np.int64))], names=[key, "size", "gram"])

    return rows.select(key, "text").mapInArrow(run, f"{key} {kind}, size int, gram long").distinct()


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def _by_shuffle(docs: DataFrame, items: DataFrame, k: int, threshold: float) -> DataFrame:
    """(key, doc_id, item, n_shared) by tables of shingles and sketches; items (item, text); key: a hash of doc_id and text."""
    full = stage(_shingled(items, "item", None, k), "leak-items")
    counts = full.groupBy("item").agg(F.count("*").alias("n"))
    top = F.pow(F.lit(2), F.ceil(F.log2("n"))).cast("long")
    lack = F.least(F.col("n"), top - F.greatest(F.lit(1), F.ceil(F.lit(threshold) * top - 1e-9)) + 1)
    sketches = full.groupBy("item").agg(F.array_sort(F.collect_list(F.struct("gram", "size"))).alias("grams")).join(counts, "item").select("item", F.explode(F.slice("grams", F.lit(1), lack.cast("int"))).alias("s")).select("item", "s.size", "s.gram")
    sizes = sorted(r["size"] for r in full.select("size").distinct().collect())
    rows = docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    grams = _shingled(rows, "key", sizes, k)
    met = stage(grams.join(sketches, ["size", "gram"]).select("key", "item").distinct(), "leak-pairs")
    texts = rows.join(met.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    both = met.join(texts, "key").join(items.withColumnRenamed("text", "wanted"), "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = []
            for text, wanted in zip(batch.column(3), batch.column(4), strict=True):
                size, own = item_shingles(wanted.as_py(), k)
                n = len(own & _grams(text.as_py(), size))
                shared.append(n if n >= needed(len(own), threshold) else None)
            found = pa.array(shared, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], names=["key", "doc_id", "item", "n_shared"]).filter(found.is_valid())

    return both.select("key", "doc_id", "item", "text", "wanted").mapInArrow(run, "key long, doc_id long, item long, n_shared long")


def _held(benchmark: DataFrame, broadcast_items: int, broadcast_bytes: int) -> list[tuple[int, str | None]] | None:
    """The distinct items (item_id, text) in order, or None if they are too many to send."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    if n > broadcast_items or size > broadcast_bytes:
        return None
    return sorted(set(map(tuple, items.collect())), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def _numbered(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().withColumn("item", F.xxhash64("item_id", "text"))


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, broadcast_items: int = BROADCAST_ITEMS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment): each document with each item that leaked into it."""
    spark = docs.sparkSession
    items = _held(benchmark, broadcast_items, broadcast_bytes)
    if items is not None:
        rows = [(n, item_id, len(item_shingles(text, k)[1])) for n, (item_id, text) in enumerate(items)]
        found = _by_broadcast(docs, items, k, threshold)
        schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("n_shingles", T.LongType())])
        return _report(found, F.broadcast(spark.createDataFrame(rows, schema)))  # a row for each of a bounded number of items
    numbered = stage(_numbered(benchmark), "leak-texts")
    found = _by_shuffle(docs, numbered.select("item", "text"), k, threshold)
    sizes = _shingled(numbered.select("item", "text"), "item", None, k).groupBy("item").agg(F.count("*").alias("n_shingles"))
    return _report(found, numbered.select("item", "item_id").join(sizes, "item"))


def _report(found: DataFrame, items: DataFrame) -> DataFrame:
    best = found.join(items, "item").withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
    top = F.max(F.struct("containment", "n_shared", "n_shingles")).alias("top")
    return best.groupBy("doc_id", "item_id").agg(top).select("doc_id", "item_id", "top.n_shared", "top.n_shingles", "top.containment")


def clean(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, threshold: float = THRESHOLD, broadcast_items: int = BROADCAST_ITEMS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the rows into which an item leaked.

    While the items can be sent to all tasks, batches of whole rows are filtered and nothing is joined.
    """
    items = _held(benchmark, broadcast_items, broadcast_bytes)
    if items is None:
        found = _by_shuffle(docs, _numbered(benchmark).select("item", "text"), k, threshold)
        name = "_leaked"
        while name in docs.columns:
            name += "_"
        return docs.withColumn(name, _key()).join(found.select(F.col("key").alias(name)).distinct(), name, "left_anti").select(*docs.columns)
    held = docs.sparkSession.sparkContext.broadcast(Index(items, k, threshold))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), bool)
            keep[[row for row, _, _ in _search(held.value, batch.column(place))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
