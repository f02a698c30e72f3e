"""Directly addressable codes: a file format for token ids with random access.

An id is split into chunks of eight bits, lowest first. Level j holds the j-th chunk of every id
that has one, one byte each; a bitmap beside it marks the ids that continue on level j + 1, and a
rank directory holds the number of marks before every 512th. Chunk j + 1 of an id then stands at
the rank of its place on level j, so any token is found by a few reads without decoding a block.

A file is: the magic, the length of a JSON header, the header (names, types and lengths of the
sections), and the sections, little-endian: doc_id and its validity, first token of each document,
and codes, bitmap and ranks of each level.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

MAGIC = b"CARRDAC1"
_BLOCK = 512
_TOGETHER = 1 << 16  #: ids that are split into levels at a time, about, or an eighth as many documents
_ONES = np.array([bin(i).count("1") for i in range(256)], np.int64)


class _Level:
    """Codes and marks of the ids that reach a level, and the level after it."""

    def __init__(self) -> None:
        self.codes, self.marks = bytearray(), bytearray()
        self._open = np.zeros(0, bool)  #: marks that don't fill a byte yet
        self.next: _Level | None = None

    def add(self, ids: np.ndarray) -> None:
        more = ids > 0xFF
        self.codes += (ids & 0xFF).astype(np.uint8).tobytes()
        marks = np.r_[self._open, more]
        full = len(marks) // 8 * 8
        self.marks += np.packbits(marks[:full], bitorder="little").tobytes()
        self._open = marks[full:]
        if more.any():
            self.next = self.next or _Level()
            self.next.add(ids[more] >> 8)

    def sections(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes, marks = np.frombuffer(bytes(self.codes), np.uint8), np.r_[np.frombuffer(bytes(self.marks), np.uint8), np.packbits(self._open, bitorder="little")]
        per_block = np.add.reduceat(_ONES[marks], np.arange(0, len(marks), _BLOCK // 8)) if len(marks) else np.zeros(0, np.int64)
        return codes, marks, np.r_[0, np.cumsum(per_block)].astype("<u8")


class Writer:
    """A file that grows by documents. What it holds are the file's sections: an id is a byte and a bit on each of its levels."""

    def __init__(self) -> None:
        self._codes, self._head = _Level(), [bytearray() for _ in range(3)]
        self._docs: list[tuple[int | None, np.ndarray]] = []
        self._waiting = self.n_docs = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._docs.append((doc_id, ids))
        self._waiting += len(ids)
        self.n_docs += 1
        self.n_ids += len(ids)
        if self._waiting >= _TOGETHER or 8 * len(self._docs) >= _TOGETHER:
            self._settle()

    def _settle(self) -> None:
        doc_ids = [d for d, _ in self._docs]
        columns = np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is not None for d in doc_ids], "u1"), np.array([len(x) for _, x in self._docs], "<i8")
        for held, new in zip(self._head, columns, strict=True):
            held += new.tobytes()
        if self._waiting:
            self._codes.add(np.concatenate([x for _, x in self._docs]).astype(np.uint32, copy=False))
        self._docs, self._waiting = [], 0

    def data(self) -> bytes:
        """The file of all documents so far."""
        self._settle()
        doc_id, known, size = (np.frombuffer(bytes(x), kind) for x, kind in zip(self._head, ("<i8", "u1", "<i8"), strict=True))
        sections = {"doc_id": doc_id, "known": known, "first": np.r_[0, np.cumsum(size)].astype("<i8")}
        level, j = self._codes, 0
        while level:
            codes, marks, ranks = level.sections()
            sections |= {f"codes{j}": codes, f"marks{j}": marks, f"ranks{j}": ranks}
            level, j = level.next, j + 1
        head = json.dumps([[name, x.dtype.str, len(x)] for name, x in sections.items()]).encode()
        return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, *map(memoryview, sections.values())])


def encode(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """A file of the documents' ids."""
    writer = Writer()
    for doc_id, ids in zip(doc_ids, docs, strict=True):
        writer.add(doc_id, ids)
    return writer.data()


def within(data: bytes) -> Callable[[int, int], memoryview]:
    """The read function of a file that is in memory."""
    view = memoryview(data)
    return lambda offset, n: view[offset : offset + n]


class Reader:
    """Random access to a file's tokens; ``read(offset, n)`` gives n bytes of it from offset.

    Opening reads the header and the documents' sections. A token takes a read of its code, of its
    mark's block and of one entry of the rank directory for each level it has.
    """

    def __init__(self, read: Callable[[int, int], bytes | memoryview]):
        self._read, self._sections = read, {}
        head = read(0, 16)
        if bytes(head[:8]) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        size = int.from_bytes(head[8:16], "little")
        at = 16 + size
        for name, kind, n in json.loads(bytes(read(16, size))):
            self._sections[name] = (at, np.dtype(kind), n)
            at += n * np.dtype(kind).itemsize
        self.doc_id, self.known, self.first = (self._part(name) for name in ("doc_id", "known", "first"))
        self.n_levels = sum(n.startswith("codes") for n in self._sections)

    def _part(self, name: str, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Entries lo to hi - 1 of a section."""
        at, kind, n = self._sections[name]
        hi = n if hi is None else min(hi, n)
        return np.frombuffer(self._read(at + lo * kind.itemsize, max(0, hi - lo) * kind.itemsize), kind)

    def __len__(self) -> int:
        return self._sections["codes0"][2]

    def _rank(self, level: int, i: int) -> int:
        """Marks before place i of a level."""
        block = i // _BLOCK
        lo, hi = block * _BLOCK // 8, i // 8
        marks = self._part(f"marks{level}", lo, hi + 1)
        part = int(_ONES[marks[: hi - lo]].sum())
        if i % 8:
            part += int(_ONES[marks[hi - lo] & ((1 << i % 8) - 1)])
        return int(self._part(f"ranks{level}", block, block + 1)[0]) + part

    def token(self, i: int) -> int:
        """The i-th id of the file."""
        value = 0
        for level in range(self.n_levels):
            value |= int(self._part(f"codes{level}", i, i + 1)[0]) << (8 * level)
            if not self._part(f"marks{level}", i // 8, i // 8 + 1)[0] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, lo: int, hi: int) -> np.ndarray:
        """The ids lo to hi - 1: a run of places on a level is a run of places on the next."""
        out = np.zeros(hi - lo, np.uint32)
        at = np.arange(hi - lo)
        for level in range(self.n_levels):
            if hi <= lo:
                break
            out[at] |= self._part(f"codes{level}", lo, hi).astype(np.uint32) << np.uint32(8 * level)
            marks = self._part(f"marks{level}", lo // 8, (hi + 7) // 8)
            more = np.unpackbits(marks, bitorder="little")[lo % 8 : lo % 8 + hi - lo].astype(bool)
            at = at[more]
            if not len(at):
                break
            lo = self._rank(level, lo)
            hi = lo + len(at)
        return out

    def document(self, i: int) -> np.ndarray:
        return self.tokens(int(self.first[i]), int(self.first[i + 1]))
