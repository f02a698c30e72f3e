"""Whitening of embeddings: streaming moments, a symmetric QR eigen-solve, unit covariance.

Entries become integers, floor(scale * c) + offset, so that sums are exact. Each distinct vector
counts once (copies are dropped by partial aggregates before a shuffle). Each task runs Welford's
rank-one updates over its vectors, and the tasks' moments are merged by the parallel update formula
in rounds of ``FAN`` parts a group, so the driver receives one matrix however many tasks there are.
The covariance is reduced to a tridiagonal matrix by reflections and solved by implicit QR steps with
shifts. A second pass measures the covariance of the whitened vectors against the identity.

Cases: vectors that are null or hold null or non-finite entries are dropped, as are those of another
length than the most common one (of equally common ones the longer) and empty ones; a null id keeps its
row; repeated rows are returned each; entries of a scaled size over 2**62 count as that; a deviation
beyond a long is null; a component whose eigenvalue is below ``LEAST`` times the largest has no
direction and isn't returned, so a table of one distinct vector, or none, gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.sources.staging import stage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
FAN = 16
LEAST = 1e-11
_FAR = 2.0**62
_ROWS = 1024
_MOMENTS = "part int, n long, mean array<double>, m2 array<double>, sums array<string>"


@dataclass(frozen=True)
class Whitening:
    n: int  #: distinct vectors
    sums: list[int]  #: of their entries, exact
    directions: np.ndarray  #: a row for each component, a unit vector
    values: np.ndarray  #: eigenvalues
    explained: np.ndarray  #: shares of the trace
    identity_error: float


class Moments:
    """Count, mean and centred products of vectors, around a fixed origin."""

    def __init__(self, dims: int):
        self.n, self.mean, self.m2 = 0, np.zeros(dims), np.zeros((dims, dims))
        self.sums = [0] * dims

    def add(self, x: np.ndarray) -> None:
        """Welford's update by one vector."""
        self.n += 1
        away = x - self.mean
        self.mean += away / self.n
        self.m2 += np.outer(away * ((self.n - 1) / self.n), away)

    def merge(self, other: Moments) -> None:
        """The parallel update by the moments of other vectors."""
        n = self.n + other.n
        if n:
            away = other.mean - self.mean
            self.m2 += other.m2 + np.outer(away * (self.n * other.n / n), away)
            self.mean += away * (other.n / n)
        self.n, self.sums = n, [a + b for a, b in zip(self.sums, other.sums, strict=True)]

    def row(self, part: int) -> pa.RecordBatch:
        values = [part, self.n, self.mean.tolist(), self.m2.ravel().tolist(), list(map(str, self.sums))]
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=["part", "n", "mean", "m2", "sums"])

    @classmethod
    def read(cls, n: int, mean: list[float], m2: list[float], sums: list[str]) -> Moments:
        out = cls(len(mean))
        out.n, out.mean, out.m2, out.sums = n, np.array(mean), np.array(m2).reshape(len(mean), -1), list(map(int, sums))
        return out


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues from the largest, unit eigenvectors as rows) of a symmetric matrix by QR steps."""
    a = (matrix + matrix.T) / 2
    n = len(a)
    rows = np.eye(n)  # row i becomes the i-th eigenvector
    for k in range(n - 2):  # reflections that leave one entry below the diagonal
        x = a[k + 1 :, k].copy()
        x[0] += math.copysign(np.linalg.norm(x), x[0])
        size = x @ x
        if size == 0:
            continue
        y = a[k + 1 :, k + 1 :] @ x * (2 / size)
        w = y - x * (x @ y / size)
        a[k + 1 :, k + 1 :] -= np.outer(x, w) + np.outer(w, x)
        head = -math.copysign(np.linalg.norm(a[k + 1 :, k]), a[k + 1, k])
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = head
        rows[k + 1 :] -= np.outer(x * (2 / size), x @ rows[k + 1 :])
    d, e = np.diag(a).tolist(), np.diag(a, 1).tolist()
    hi = n - 1
    tiny = np.finfo(float).eps
    while hi > 0:
        lo = hi
        while lo and abs(e[lo - 1]) > tiny * (abs(d[lo - 1]) + abs(d[lo])):
            lo -= 1
        if lo == hi:
            hi -= 1
            continue
        half = (d[hi - 1] - d[hi]) / 2  # the eigenvalue of the last two rows that is nearer to the last entry
        shift = d[hi] - e[hi - 1] ** 2 / (half + math.copysign(math.hypot(half, e[hi - 1]), half))
        x, z = d[lo] - shift, e[lo]
        for k in range(lo, hi):
            r = math.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > lo:
                e[k - 1] = r
            p, q, off = d[k], d[k + 1], e[k]
            d[k] = c * c * p + 2 * c * s * off + s * s * q
            d[k + 1] = s * s * p - 2 * c * s * off + c * c * q
            e[k] = c * s * (q - p) + (c * c - s * s) * off
            if k + 1 < hi:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
            rows[[k, k + 1]] = np.array([[c, s], [-s, c]]) @ rows[k : k + 2]
    order = np.argsort(-np.array(d), kind="stable")
    rows = rows[order]
    rows *= np.sign(rows[np.arange(n), np.abs(rows).argmax(axis=1)])[:, None]
    return np.array(d)[order], rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    """Vectors without null and non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def integers(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, x): the usable vectors of the most common length as integers."""
    vector = F.col(column)
    good = vectors.select(F.col(key), vector).filter(_usable(vector))
    sizes = good.groupBy(F.size(vector).alias("dims")).agg(F.count("*").alias("n"))
    top = sizes.agg(F.max(F.struct("n", "dims")).alias("top")).first()["top"]
    scaled = F.transform(vector, lambda c: F.floor(F.greatest(F.lit(-_FAR), F.least(F.lit(_FAR), SCALE * c.cast("double")))) + F.lit(OFFSET).cast("long"))
    return good.filter(F.size(vector) == (top["dims"] if top else 0)).select(F.col(key), scaled.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _merged(moments: DataFrame, parts: int) -> Moments | None:
    """All moments in one; at most ``FAN`` of them, each of bounded size, meet in a task."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("part", "n", "mean", "m2", "sums")), strict=True), key=lambda r: r[0])
        out = Moments.read(*rows[0][1:])
        for row in rows[1:]:
            out.merge(Moments.read(*row[1:]))
        return pa.Table.from_batches([out.row(key[0].as_py())])

    while parts > 1:
        moments = moments.groupBy(F.floor(F.col("part") / FAN).cast("int").alias("group")).applyInArrow(merge, _MOMENTS)
        parts = -(-parts // FAN)
    found = moments.first()
    return Moments.read(*found[1:]) if found else None


def _moments(fit: DataFrame, project: tuple[int, list[int], np.ndarray] | None = None) -> Moments | None:
    """Of the vectors x less the offset, or of what (n, sums, weights) make of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            for lo in range(0, len(batch), _ROWS):
                x = _matrix(batch.column(0).slice(lo, _ROWS))
                if project is None:
                    rows = (x - OFFSET).astype(float)
                else:
                    rows = _centred(x, *project[:2]) @ project[2]
                out = out or Moments(rows.shape[1])
                for row in rows:
                    out.add(row)
                if project is None:
                    out.sums = [a + (int(h) << 20) + int(b) for a, h, b in zip(out.sums, (x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0), strict=True)]
        if out is not None:
            yield out.row(TaskContext.get().partitionId())

    made = stage(fit.select("x").mapInArrow(run, _MOMENTS), "whitening-moments")
    parts = made.agg(F.max("part")).first()[0]
    return None if parts is None else _merged(made, parts + 1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean: of exact differences where a long holds them."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        return (x * n - np.array(sums)) / n
    return np.array([[float(n * v - s) / n for v, s in zip(row, sums, strict=True)] for row in x.tolist()])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62 and max(map(abs, sums)) < 1 << 62:
        away = x * n - np.array(sums)
        if (away.astype(float) ** 2).sum(axis=1).max(initial=0) < 2.0**62:
            return (away * away).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x``; None where there are none."""
    distinct = stage(vectors.select("x").distinct(), "whitening-fit")
    found = _moments(distinct)
    if found is None:
        return None
    cov = found.m2 / found.n
    values, rows = eigen(cov)
    trace = float(np.trace(cov))
    k = min(components, int((values > LEAST * max(values[0], 0)).sum())) if values[0] > 0 else 0
    values, rows = values[:k], rows[:k]
    error = 0.0
    if k:
        again = _moments(distinct, (found.n, found.sums, rows.T / np.sqrt(values)))
        error = float(np.abs(again.m2 / again.n - np.eye(k)).max())
    return Whitening(found.n, found.sums, rows, values, values / trace if k else values, error)


def whitened(vectors: DataFrame, model: Whitening | None, key: str = "vec_id") -> DataFrame:
    """A row for each vector and component: (key, component, n, deviation, whitened, explained, identity_error)."""
    kind = vectors.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values) if model else 0
        if not k:
            return
        weights = model.directions.T / np.sqrt(model.values)
        for whole in batches:
            for lo in range(0, len(whole), _ROWS):
                batch = whole.slice(lo, _ROWS)
                x = _matrix(batch.column(1))
                rows = len(x)
                own = batch.column(0).take(pa.array(np.repeat(np.arange(rows), k)))
                deviation = pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k)))
                found = _centred(x, model.n, model.sums) @ weights
                columns = [own, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n)), deviation, pa.array(found.ravel()), pa.array(np.tile(model.explained, rows)), pa.array(np.full(rows * k, model.identity_error))]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select(key, "x").mapInArrow(run, schema)
