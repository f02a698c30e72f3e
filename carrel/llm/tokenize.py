"""Token-ID output: whole texts to files of directly addressable codes, and back.

Documents are range-partitioned by doc_id and tokenised in order; each task writes its files,
which follow one another in doc_id order, into the shared folder, and a table of the files is
kept as Parquet. Readers get a row for each file and open it where they run.

The tokenizer sees a piece of text once for each worker that holds it: a text falls apart, before every space
and line break that follow no white space, into pieces that the tokenizer's pre-tokenization never
joins. Texts with other runs of white space are encoded as one piece, as are those that hold one of the
tokenizer's added tokens (such as its end of text), which become their ids as the tokenizers library has it.
Pieces are looked up by hash and compared byte by byte, so none gets the ids of another.

Cases: a null or empty text has the end id only; repeated rows are encoded each; rows with a null
doc_id come first; an empty table gives no file; further columns are ignored.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carrel.llm import dac
from carrel.llm.files import read_range, read_whole, write_whole
from carrel.sources.staging import fresh_dir, small_batches, stage
from carrel.llm.words import Chunk, chunks, mix, same_bytes

END = 2
FILE_TOKENS = 4_000_000
_CACHED_PIECES = 1 << 20  #: by a worker; rarer ones are encoded for each chunk of texts
_CHUNK_BYTES = 1 << 19  #: of texts that a worker works on at a time: arrays over them take some fifty times as much
_TOGETHER = 1 << 12  #: words that the library encodes in one call, as it keeps over a hundred bytes for each id until it returns
_SPACE, _LINE, _NONE = 0, 1, 2  #: before a piece's word: a space, a line break, the start of the text


def _room(x: np.ndarray, need: int) -> np.ndarray:
    return x if need <= len(x) else np.r_[x, np.zeros(max(len(x), need), x.dtype)]


class Encoder:
    """Ids of texts by the tokenizers library, which encodes each distinct piece once.

    Pieces are known by 64-bit hashes; ``keys`` is sorted, ``entry`` has each one's number, by which first and count give
    its ids in ``flat``, and text and size its word in ``bytes``. A count of -1 marks a piece whose texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line = self.whole("\n")
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.first, self.text = (np.zeros(1 << 16, np.int64) for _ in range(2))
        self.count, self.size = (np.zeros(1 << 16, np.int32) for _ in range(2))
        self.flat, self.bytes = np.zeros(1 << 20, np.uint32), np.zeros(1 << 20, np.uint8)
        self.used = self.used_bytes = 0

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _pieces(self, words: list[str], head: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of the words, each behind head, a space or a line break."""
        found = [self._together(words[lo : lo + _TOGETHER], head) for lo in range(0, len(words), _TOGETHER)]
        return np.concatenate([np.zeros(0, np.uint32), *(ids for ids, _ in found)]), np.concatenate([np.zeros(0, np.int64), *(n for _, n in found)])

    def _together(self, words: list[str], head: str) -> tuple[np.ndarray, np.ndarray]:
        """The same, encoded as one text, of one word a line; a line break is a token of its own."""
        spaced = head == " "
        ids = self.whole("\n".join(" " + w for w in words) if spaced else "".join("\n" + w for w in words))
        cut = ids == self.line[0]
        counts = np.diff(np.r_[-1 if spaced else [], np.flatnonzero(cut), len(ids)].astype(np.int64)) - spaced
        if len(self.line) == 1 and len(counts) == len(words):
            return (ids[~cut] if spaced else ids), counts
        each = [self.whole(head + w) for w in words]
        return np.concatenate(each), np.array([len(x) for x in each])

    def _learn(self, keys: np.ndarray, words: list[str], kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, count) of new pieces; kind: what stands before the word."""
        firsts, counts = np.zeros(len(words), np.int64), np.full(len(words), -1)
        for k, head in ((_SPACE, " "), (_LINE, "\n"), (_NONE, "\n")):
            own = [i for i in np.flatnonzero(kind == k).tolist() if words[i].strip() == words[i]]
            ids, n = self._pieces([words[i] for i in own], head)
            need = self.used + len(ids)
            self.flat = _room(self.flat, need)
            self.flat[self.used : need] = ids
            drop = int(k == _NONE) * len(self.line)  # the line break before it is no part of the text
            firsts[own] = self.used + np.cumsum(n) - n + drop
            counts[own] = n - drop
            self.used = need
        return firsts, counts

    def _entries(self, chunk: Chunk, key: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first, count) of every word's ids; a word whose hash is that of another has the count -1."""
        wanted, where, number = np.unique(key, return_index=True, return_inverse=True)
        start, end = chunk.start[where], chunk.end[where]
        at = np.searchsorted(self.keys, wanted)
        known = np.zeros(len(wanted), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == wanted[inside]
        first, count = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        old = np.flatnonzero(known)
        entry = self.entry[at[old]]
        first[old], count[old] = self.first[entry], self.count[entry]
        false = self.size[entry] != end[old] - start[old]
        like = old[~false]
        false[~false] = ~same_bytes(chunk.data, start[like], end[like], self.bytes, self.text[entry[~false]])
        count[old[false]] = -1
        new = np.flatnonzero(~known)
        if len(new):
            data = chunk.data.tobytes()
            found = [data[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)]
            full, used = len(self.keys) + len(new) > _CACHED_PIECES, self.used
            first[new], count[new] = self._learn(wanted[new], [w.decode() for w in found], kind[where[new]])
            if full:  # what came first is what comes most; the rest isn't kept
                self.used = used
            else:
                size = end[new] - start[new]
                need = self.used_bytes + int(size.sum())
                self.bytes = _room(self.bytes, need)
                self.bytes[self.used_bytes : need] = np.frombuffer(b"".join(found), np.uint8)
                text = self.used_bytes + np.cumsum(size) - size
                self.used_bytes = need
                known_before, known_now = len(self.keys), len(self.keys) + len(new)
                self.keys = np.insert(self.keys, at[new], wanted[new])
                self.entry = np.insert(self.entry, at[new], np.arange(known_before, known_now, dtype=np.int32))
                for name, values in (("first", first[new]), ("count", count[new]), ("text", text), ("size", size)):
                    setattr(self, name, held := _room(getattr(self, name), known_now))
                    held[known_before:known_now] = values
        counts = count[number]
        size = end - start
        counts[chunk.end - chunk.start != size[number]] = -1
        like = np.flatnonzero(counts >= 0)
        counts[like[~same_bytes(chunk.data, chunk.start[like], chunk.end[like], chunk.data, start[number[like]])]] = -1
        return first[number], counts

    def _with_added(self, chunk: Chunk) -> np.ndarray:
        """Which documents hold an added token."""
        found, data = np.zeros(chunk.n_docs, bool), chunk.data.tobytes()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                i = int(np.searchsorted(chunk.doc_bytes, at, "right")) - 1
                found[i] = True
                at = data.find(token, max(at + 1, int(chunk.doc_bytes[i + 1]) - len(token) + 1))
        return found

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn, null as empty."""
        for chunk in chunks(texts, _CHUNK_BYTES):
            start, end, bounds = chunk.start, chunk.end, chunk.bounds
            used = bounds[:-1] < bounds[1:]
            head = np.zeros(len(start), bool)
            head[bounds[:-1][used]] = True
            before = np.r_[0, end[:-1]] if len(end) else end
            before[head] = chunk.doc_bytes[:-1][used]
            gap = start - before
            mark = chunk.data[start - 1]
            kind = np.where(head, _NONE, np.where(mark == 32, _SPACE, _LINE))
            plain = np.where(head, gap == 0, (gap == 1) & ((mark == 32) | (mark == 10)))
            key = mix(chunk.hashes(lower=False) + kind.astype(np.uint64))
            first, count = self._entries(chunk, key, kind) if len(key) else (gap, gap)
            bad = np.r_[0, np.cumsum(~plain | (count < 0))]
            ends = np.cumsum(np.maximum(count, 0))
            total = int(ends[-1]) if len(ends) else 0
            ids = self.flat[np.repeat(first - (ends - np.maximum(count, 0)), np.maximum(count, 0)) + np.arange(total)]
            starts = np.r_[0, ends]
            added = self._with_added(chunk)
            for i in range(chunk.n_docs):
                lo, hi = bounds[i], bounds[i + 1]
                tail = chunk.doc_bytes[i + 1] - (end[hi - 1] if hi > lo else chunk.doc_bytes[i])
                if tail or added[i] or bad[hi] > bad[lo]:
                    yield self.whole(texts[chunk.first + i].as_py())
                else:
                    yield ids[starts[lo] : starts[hi]]


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each Python worker, which serves many tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end: int = END, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the files and returns their table: (part, seq, path, n_docs, n_tokens, start).

    ``tokenizer`` is the path of a tokenizers file on every executor; start counts the ids of all
    files before. The windows that add them up see a row for each part and for each file of one, no documents.
    """
    folder = folder or fresh_dir(docs.sparkSession, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        part, seq = TaskContext.get().partitionId(), 0
        file = dac.Writer()

        def flush() -> pa.RecordBatch:
            # a name of its own for every attempt: the table always names a file that its rows fit
            path = f"{folder}/part-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            write_whole(path, file.data())
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [path], "n_docs": pa.array([file.n_docs], pa.int64()), "n_tokens": pa.array([file.n_ids], pa.int64())})

        for batch in batches:
            for doc_id, own in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                file.add(doc_id, np.append(own, np.uint32(end)))
                if file.n_ids >= file_tokens:
                    yield flush()
                    seq, file = seq + 1, dac.Writer()
        if file.n_docs:
            yield flush()

    order = ["doc_id", "_text_key"]  # rows of one doc_id stand in the same order in every run
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_text_key")).repartitionByRange(*order).sortWithinPartitions(*order).drop("_text_key")
    with small_batches(docs.sparkSession):
        table = stage(ordered.mapInArrow(run, "part int, seq int, path string, n_docs long, n_tokens long"), "token-files")
    parts = table.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = parts.select("part", (F.sum("_n").over(W.orderBy("part")) - F.col("_n")).alias("_before"))
    inside = F.sum("n_tokens").over(W.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    return table.withColumn("_inside", inside).join(before, "part").select(*table.columns, (F.col("_before") + F.col("_inside")).alias("start"))


def opened(path: str) -> dac.Reader:
    """Random access to a file by range reads: the header, then the bytes that a token or document needs."""
    return dac.Reader(lambda offset, n: read_range(path, offset, n))


def read_tokens(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = dac.Reader(dac.within(read_whole(path)))  # every token is wanted; for a few, see ``opened``
                n = len(reader.doc_id)
                sums = [zlib.crc32(reader.document(i).astype("<u4").tobytes()) for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(reader.doc_id, mask=reader.known == 0), pa.array(reader.first[:-1] + start), pa.array(np.diff(reader.first)), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "start").repartition(tasks, "path").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
