"""Words of whole Arrow batches, found and hashed with numpy instead of one by one.

A word is a run of bytes other than space and 0x09-0x0D. Its hash is 64 bits wide, and equal
for equal byte sequences, whatever batch or task they stand in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21
_COMPARED = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_pow = np.ones(1, _U)
_inv = np.ones(1, _U)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits; a bijection."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BYTE = mix((np.arange(256, dtype=_U) + _U(1)) * _U(_BASE))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, CHUNK_BYTES // 4)
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _pow = np.cumprod(np.r_[_U(1), np.full(size, _U(_BASE))], dtype=_U)
            _inv = np.cumprod(np.r_[_U(1), np.full(size, _U(inverse))], dtype=_U)
    return _pow, _inv


@dataclass
class Chunk:
    """Words of the documents ``first`` to ``first + n_docs - 1`` of a batch."""

    first: int
    n_docs: int
    data: np.ndarray  #: the bytes of all texts
    start: np.ndarray  #: of each word, in data
    end: np.ndarray
    bounds: np.ndarray  #: words of document i: bounds[i] to bounds[i + 1] - 1
    doc_bytes: np.ndarray  #: bytes of document i: doc_bytes[i] to doc_bytes[i + 1] - 1
    _sums: np.ndarray | None = None

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.bounds))

    def hashes(self, lower: bool, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Of each word, or of the byte ranges given; lower: with A-Z as a-z."""
        power, inverse = _powers(len(self.data) + 1)
        if self._sums is None:
            data = LOWER[self.data] if lower else self.data
            self._sums = np.zeros(len(data) + 1, _U)
            np.cumsum(_BYTE[data] * power[: len(data)], out=self._sums[1:])
        start = self.start if start is None else start
        end = self.end if end is None else end
        return mix((self._sums[end] - self._sums[start]) * inverse[start])

    def windows(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of each run of k words inside one document, in order."""
        n = len(hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        left = np.repeat(self.bounds[1:], np.diff(self.bounds))[:n] - np.arange(n)
        at = np.flatnonzero(left >= k)
        total = np.zeros(n, _U)
        factor = _U(1)
        with np.errstate(over="ignore"):
            for j in range(k):
                total += hashes[j : n + j] * factor
                factor *= _U(_BASE)
        return at, mix(total[at] + _U(k))


def same_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether data[start[i]:end[i]] stands at other[at[i]], for each i; the ranges lie inside both, which hold under 2 GB."""
    size = (end - start).astype(np.int64)
    same = np.ones(len(size), bool)
    lo = 0
    edges = np.r_[0, np.cumsum(size)]
    while lo < len(size):  # a bounded number of bytes at a time
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + _COMPARED, "right")) - 1)
        own, shift = np.arange(edges[hi] - edges[lo], dtype=np.int32), edges[lo:hi] - edges[lo]
        left = np.repeat((start[lo:hi] - shift).astype(np.int32), size[lo:hi])
        right = np.repeat((at[lo:hi] - shift).astype(np.int32), size[lo:hi])
        left += own
        right += own
        differ = np.flatnonzero(data[left] != other[right])
        same[lo + np.searchsorted(edges[lo : hi + 1] - edges[lo], differ, "right") - 1] = False
        lo = hi
    return same


def chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES, between: np.ndarray = _SPACE) -> Iterator[Chunk]:
    """Splits a column of texts (null: empty) into chunks; a text is never divided. between: which bytes belong to no word."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, "right")) - 1)
        hi = min(hi, n)
        part = data[offsets[lo] : offsets[hi]]
        edges = offsets[lo : hi + 1] - offsets[lo]
        word = ~between[part]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        heads = edges[:-1][edges[:-1] < edges[1:]]
        tails = edges[1:][edges[:-1] < edges[1:]] - 1
        first[heads] = word[heads]
        last[tails] = word[tails]
        start = np.flatnonzero(first)
        yield Chunk(lo, hi - lo, part, start, np.flatnonzero(last) + 1, np.searchsorted(start, edges), edges)
        lo = hi
