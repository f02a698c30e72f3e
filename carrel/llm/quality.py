"""Quality classifier: similarity-weighted votes of the nearest labelled latent-semantic vectors.

Terms are shapes of words and of neighbouring word pairs: the kind of the first and last character,
length, capitals, and whether a word repeats one of the two before it. They are the same in all
languages. A document's square-root term counts, weighted by inverse document frequency, are
projected onto the leading right singular vectors of the labelled sample. Each document is then
compared with every labelled vector by exact cosine products in blocks, and its nearest ones vote,
each with its similarity to a power.

The labelled sample is bounded: at most ``sample`` documents (parameter), the same number of each
label where there are enough, chosen by a hash of doc_id, and each counts by the share that its label
has among all training rows, so scores don't depend on the sample; the model sent to the executors has at
most sample * rank + terms * rank numbers, whatever the input.

Cases: a null, empty or wordless text has no terms and gets the share of label 1 among the training rows;
without any labelled document every score is 0.5; conflicting labels of one doc_id count by their
mean, 0.5 as 1; a doc_id trains once, by one of its texts; rows with a null doc_id or label don't train; repeated rows give repeated result
rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.llm.words import Chunk, chunks
from carrel.sources.staging import stage

SAMPLE = 4096
RANK = 48
NEIGHBOURS = 15
POWER = 4
KEEP = 0.3

_KINDS = np.full(256, 5, np.uint8)  # symbols
_KINDS[97:123] = 0
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[[ord(c) for c in ".,;:'\"()-?"]] = 3
_KINDS[ord("!")] = 4
_KINDS[128:] = 6
_KINDS[ord("|")] = 7
_UPPER = (_KINDS == 1).astype(np.int32)
N_SINGLE = 8 * 8 * 4 * 3 * 2
N_PAIR = 512
TERMS = N_SINGLE + N_PAIR


def _terms(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(document, term) of each word and each pair of neighbouring words."""
    doc = chunk.doc_of_word()
    kind = _KINDS[chunk.data]
    first, last = kind[chunk.start].astype(np.int64), kind[chunk.end - 1].astype(np.int64)
    length = np.minimum((chunk.end - chunk.start - 1) // 3, 3)
    capitals = np.r_[0, np.cumsum(_UPPER[chunk.data])]
    n_upper = capitals[chunk.end] - capitals[chunk.start]
    upper = np.where(n_upper > 1, 2, n_upper)
    hashed = chunk.hashes(lower=True)
    again = np.zeros(len(hashed), np.int64)
    for lag in (1, 2):
        if len(hashed) > lag:
            again[lag:] |= (hashed[lag:] == hashed[:-lag]) & (doc[lag:] == doc[:-lag])
    single = (((first * 8 + last) * 4 + length) * 3 + upper) * 2 + again
    coarse = ((first * 8 + last) * 3 + upper) * 2 + again
    same = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, np.int64)
    pair = (coarse[same] * 389 + coarse[same + 1]) * 2654435761 % (1 << 32) % N_PAIR + N_SINGLE
    return np.r_[doc, doc[same]], np.r_[single, pair]


def term_counts(chunk: Chunk) -> np.ndarray:
    doc, term = _terms(chunk)
    return np.bincount(doc * TERMS + term, minlength=chunk.n_docs * TERMS).reshape(chunk.n_docs, TERMS).astype(np.float32)


class Model:
    """Projection, labelled vectors and their labels; fit on term counts and labels 0/1.

    weights: how much a row of label 0, and of label 1, counts.
    """

    def __init__(self, counts: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS, weights: tuple[float, float] = (1.0, 1.0)):
        used = counts.sum(axis=1) > 0
        each = np.where(labels > 0, weights[1], weights[0]).astype(np.float32)
        self.prior = float(np.average(labels, weights=each)) if len(labels) else 0.5
        counts, labels, each = counts[used], labels[used].astype(np.float32), each[used]
        self.labels, self.each = labels, each
        self.neighbours = min(neighbours, len(labels))
        if not len(labels):
            return
        self.idf = np.log((1 + each.sum()) / (1 + each @ (counts > 0))).astype(np.float32) + 0.1
        x = self._weighted(counts)
        rng = np.random.default_rng(7)
        basis = rng.standard_normal((TERMS, min(rank + 16, TERMS))).astype(np.float32)
        for _ in range(6):
            basis, _ = np.linalg.qr(x.T @ (each[:, None] * (x @ basis)))
        _, _, v = np.linalg.svd(np.sqrt(each)[:, None] * (x @ basis), full_matrices=False)
        self.projection = (basis @ v.T)[:, :rank].astype(np.float32)
        self.vectors = self._unit(x @ self.projection)

    def _weighted(self, counts: np.ndarray) -> np.ndarray:
        return self._unit(np.sqrt(counts) * self.idf)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        rows = np.flatnonzero(counts.any(axis=1))
        if not self.neighbours:
            return out
        for lo in range(0, len(rows), 256):
            at = rows[lo : lo + 256]
            cosine = self._unit(self._weighted(counts[at]) @ self.projection) @ self.vectors.T
            near = np.argpartition(cosine, -self.neighbours, axis=1)[:, -self.neighbours :]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6) ** POWER * self.each[near]
            out[at] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def _one_label(labels: DataFrame, label: str, keep: Column) -> DataFrame:
    """(doc_id, y) of all training rows."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & keep)
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))


def label_weights(labels: DataFrame, label: str, keep: Column, sample: int) -> tuple[float, float]:
    """How much a row of each label of ``labelled_sample`` counts: its label's share of all rows by that of the sample.

    The mean over the sample is 1.
    """
    count = {r.y: r.n for r in _one_label(labels, label, keep).groupBy("y").agg(F.count("*").alias("n")).collect()}
    drawn = {y: min(n, sample // 2) for y, n in count.items()}
    mean = sum(count.values()) / max(1, sum(drawn.values()))
    return tuple(count[y] / drawn[y] / mean if drawn.get(y) else 1.0 for y in (0, 1))


def labelled_sample(labels: DataFrame, label: str, keep: Column, sample: int) -> DataFrame:
    """(doc_id, y): at most sample / 2 ids of each label, those of the smallest hashes."""
    one = _one_label(labels, label, keep)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [one.filter(F.col("y") == y).orderBy(*order).limit(sample // 2) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def training_rows(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, y): one row for each chosen id that ``docs`` has, however often it has it.

    Of several texts of one id the one of the smallest hash trains. Staged: it is read more than once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return stage(one.select("doc_id", "text", "y"), "labelled")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", keep: Column | None = None, sample: int = SAMPLE) -> Model:
    """Trains on labelled documents for which ``keep`` (a condition on doc_id) holds."""
    keep = ~held_out(F.col("doc_id")) if keep is None else keep
    chosen = labelled_sample(labels, label, keep, sample)
    rows = training_rows(docs, chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                counts = np.minimum(term_counts(chunk), 65535).astype(np.uint16)
                packed = [zlib.compress(c.tobytes(), 1) for c in counts]
                part = batch.slice(chunk.first, chunk.n_docs)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(packed, pa.binary())], names=["doc_id", "y", "counts"])

    found = rows.mapInArrow(run, "doc_id long, y int, counts binary").collect()  # at most ``sample`` rows
    found = sorted({(r[0], r[1], bytes(r[2])) for r in found})
    counts = np.array([np.frombuffer(zlib.decompress(r[2]), np.uint16) for r in found], np.float32).reshape(len(found), TERMS)
    return Model(counts, np.array([r[1] for r in found], np.float32), weights=label_weights(labels, label, keep, sample))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1), 1 << 19):
                found = held.value.scores(term_counts(chunk))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n_docs), pa.array(found)], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = KEEP) -> DataFrame:
    """``docs`` without those that score below the threshold; no column is added or lost.

    Scoring works on batches of whole rows, so nothing is joined.
    """
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(place), 1 << 19):
                keep = held.value.scores(term_counts(chunk)) >= threshold
                yield batch.slice(chunk.first, chunk.n_docs).filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
