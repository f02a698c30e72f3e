"""Substring dedup by relative Lempel-Ziv factors against an index of every document.

The reference is all documents of smaller doc_id. Its index holds every window of 13 consecutive
words, by a 64-bit hash, dealt over blocks by that hash. Parsing a document looks up the window at
each word in the block that would hold it, which names a place of the reference: the document of the
smallest doc_id that has the window, and where it stands there. A factor (reference document, place
in it, length) starts at a found window and is extended greedily while the next window is found at
the next place of the same reference. Factors, of 13 words or more, are the duplicate spans. As every
window is looked up, those across the boundary of two factors are as well.

A longer factor rests on several lookups that agree on neighbouring places. One of a single window
rests on one hash, so its words are held against the words of its reference: both texts' buckets
give a digest of them, and a window whose digests differ is dropped.

The looked-up window and the indexed one are the same row: a block learns the smallest doc_id of
each hash and returns the places of larger ones. Before anything is sent, a task settles equal
windows among the texts it holds at a time, so a passage that a third of all documents share
reaches its block once a chunk and not once a document.

Texts and the places found in them meet in buckets of documents. A task packs the texts for a bucket
together and sends a text that it holds several times under one doc_id once, with its number.

Cases: a null or wordless text has no words; equal windows of one doc_id, and so those of repeated
rows, are no duplicates of each other; a null doc_id comes after all others and is not smaller than
another null; an empty table gives an empty result; further columns are ignored. Of two windows of
different words and one hash the later is not looked up again; that takes a collision of 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.llm.words import chunks, mix
from carrel.sources.staging import stage

WINDOW = 13
BLOCK_BYTES = 16 << 20  #: of text for each block of the index, at most as many as windows fit a task
_CHUNK = 2 << 20
_PACK_BYTES = 16 << 20  #: of texts that a task packs at a time
_LAST = 2**63 - 1  #: stands for a null doc_id
_REPEATS = 1000  #: rows that stand for one repeated row at a time
_REFS = ["ref_docs", "ref_keys", "ref_places"]
_NAMES = ["block", "docs", "keys", "counts", "hashes", "places", *_REFS]
_SENT = ", ".join(f"{n} {'int' if n == 'block' else 'binary'}" for n in _NAMES)
_HITS = ["bucket", "docs", "keys", "counts", "places", *_REFS]
_FOUND = ", ".join(f"{n} {'int' if n == 'bucket' else 'binary'}" for n in _HITS)
_PROBES = "bucket int, doc long, key int, place int, tag_doc long, tag_key int, tag_place int"
_SEEN = "tag_doc long, tag_key int, tag_place int, digest string"
_PACKED = "bucket int, docs binary, keys binary, times binary, sizes binary, texts binary"


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpack(data: bytes, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _documents(ids: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ids as packed steps, keys, counts as packed numbers) of a message."""
    with np.errstate(over="ignore"):
        steps = np.diff(ids, prepend=np.int64(0))
    return _pack(steps), keys.tobytes(), _pack(counts.astype(np.int32))


def _read_documents(docs: bytes, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.frombuffer(keys, np.int32)
    with np.errstate(over="ignore"):
        return np.cumsum(_unpack(docs, "i8", len(own)), dtype=np.int64), own, _unpack(counts, "i4", len(own))


def _rows(rows: list[tuple], names: list[str]) -> dict[str, pa.Array]:
    """Columns of binaries behind one of numbers."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return {n: pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, (n, c) in enumerate(zip(names, columns, strict=True))}


def _references(places: np.ndarray, docs: np.ndarray, keys: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Reference documents, keys and places of found windows; the last as their distance to the windows' own."""
    return _pack(docs), _pack(keys.astype(np.int32)), _pack((at - places).astype(np.int32))


def _read_references(places: np.ndarray, packed: tuple[bytes, bytes, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, keys, off = (_unpack(x, kind, len(places)) for x, kind in zip(packed, ("i8", "i4", "i4"), strict=True))
    return docs, keys, places + off


def _message(block: int, doc: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray, hashes: np.ndarray | None, refs: tuple[bytes, bytes, bytes] = (b"", b"", b"")) -> tuple:
    """A row for a block: windows (or, without hashes, settled duplicates and their references) in document order."""
    used, counts = np.unique(doc, return_counts=True)
    steps = np.diff(places, prepend=0).astype(np.int32)
    return block, *_documents(ids[used], keys[used], counts), None if hashes is None else hashes.tobytes(), _pack(steps), *refs


def _earlier(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The entry of the smallest id among those of an equal hash, -1 where no id is smaller."""
    order = np.argsort(hashes, kind="stable").astype(np.int32)
    ordered = hashes[order]
    head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    group = np.repeat(np.arange(len(head), dtype=np.int32), np.diff(np.r_[head, len(ordered)]))
    del ordered
    own = ids[order]
    least = np.minimum.reduceat(own, head)
    later = own > least[group]
    first = np.flatnonzero(~later)
    first = first[np.r_[True, group[first][1:] != group[first][:-1]]]
    found = np.full(len(hashes), -1, np.int32)
    found[order[later]] = order[first][group[later]]
    return found


def _send(batches: Iterator[pa.RecordBatch], window: int, blocks: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keys = batch.column(2).to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column(1), _CHUNK):
            first, hashes = chunk.windows(chunk.hashes(lower=False), window)
            if not len(first):
                continue
            doc = np.searchsorted(chunk.bounds, first, "right") - 1
            place = first - chunk.bounds[doc]
            own, own_keys = ids[chunk.first : chunk.first + chunk.n_docs], keys[chunk.first : chunk.first + chunk.n_docs]
            earlier = _earlier(hashes, own[doc])
            rows = []
            at = np.flatnonzero(earlier >= 0)
            if len(at):
                ref = earlier[at]
                refs = _references(place[at], own[doc[ref]], own_keys[doc[ref]], place[ref])
                # settled windows need no block of their own, so each chunk names another, whatever its texts begin with
                salt = mix(own[:1].view(np.uint64) ^ mix(own_keys[:1].astype(np.uint64)))[0]
                rows.append(_message(int(salt % np.uint64(blocks)), doc[at], own, own_keys, place[at], None, refs))
            open_ = np.flatnonzero(earlier < 0)
            block = (hashes[open_] % np.uint64(blocks)).astype(np.int32)
            order = np.argsort(block, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):  # blocks that get nothing cost nothing
                at = open_[part]
                rows.append(_message(int(block[part[0]]), doc[at], own, own_keys, place[at], hashes[at]))
            yield pa.RecordBatch.from_pydict(_rows(rows, _NAMES))


def _buckets(ids: np.ndarray, keys: np.ndarray, n: int) -> np.ndarray:
    """Which bucket each document belongs to."""
    return (mix(ids.view(np.uint64) ^ mix(keys.astype(np.uint64))) % np.uint64(n)).astype(np.int32)


def _settle(sent: pa.Table, buckets: int) -> pa.Table:
    """One block: (bucket, documents, places, references) of the windows found with a smaller doc_id."""
    ids, keys, owner, places, hashes, held = [], [], [], [], [], 0
    settled: list[tuple] = []
    for docs, own, counts, hashed, steps, *refs in zip(*(sent.column(n).to_pylist() for n in _NAMES[1:]), strict=True):
        i, k, counts = _read_documents(docs, own, counts)
        total = int(counts.sum())
        where = np.cumsum(_unpack(steps, "i4", total), dtype=np.int32)
        if hashed is None:
            settled.append((np.repeat(i, counts), np.repeat(k, counts), where, *_read_references(where, tuple(refs))))
            continue
        ids.append(i)
        keys.append(k)
        owner.append(np.repeat(np.arange(held, held + len(i), dtype=np.int32), counts))
        places.append(where)
        hashes.append(np.frombuffer(hashed, np.uint64))
        held += len(i)
    found = settled
    if ids:
        ids, keys, owner, places, hashes = map(np.concatenate, (ids, keys, owner, places, hashes))
        earlier = _earlier(hashes, ids[owner])
        del hashes
        at = np.flatnonzero(earlier >= 0)
        ref = earlier[at]
        found = [*settled, (ids[owner[at]], keys[owner[at]], places[at], ids[owner[ref]], keys[owner[ref]], places[ref])]
    doc, key, place, ref_doc, ref_key, ref_place = (np.concatenate(c) for c in zip(*found, strict=True))
    bucket = _buckets(doc, key, buckets)
    order = np.lexsort((place, key, doc, bucket))
    rows = []
    for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        heads = np.flatnonzero(np.r_[True, (doc[own][1:] != doc[own][:-1]) | (key[own][1:] != key[own][:-1])])
        packed = _documents(doc[own[heads]], key[own[heads]], np.diff(np.r_[heads, len(own)]))
        rows.append((int(bucket[own[0]]), *packed, _pack(np.diff(place[own], prepend=np.int32(0)).astype(np.int32)), *_references(place[own], ref_doc[own], ref_key[own], ref_place[own])))
    return pa.table(_rows(rows, _HITS))


def _hits(found: pa.Table) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """((doc_id, key), rows (place, reference doc_id, key, place) in order of place) of each document of a bucket."""
    by: dict[tuple[int, int], list[np.ndarray]] = {}
    for docs, keys, counts, steps, *refs in zip(*(found.column(n).to_pylist() for n in _HITS[1:]), strict=True):
        ids, own, counts = _read_documents(docs, keys, counts)
        places = np.cumsum(_unpack(steps, "i4", int(counts.sum())), dtype=np.int32)
        rows = np.stack([places, *_read_references(places, tuple(refs))], axis=1).astype(np.int64)
        for i, k, part in zip(ids.tolist(), own.tolist(), np.split(rows, np.cumsum(counts)[:-1]), strict=True):
            by.setdefault((i, k), []).append(part)
    for of, parts in by.items():
        rows = np.concatenate(parts)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        # repeated rows of one document bring their windows more than once
        yield of, rows[np.r_[True, rows[1:, 0] != rows[:-1, 0]]]


def _lone(found: pa.Table, buckets: int) -> pa.Table:
    """Probes of one bucket: the place of each factor of a single window, and that of its reference.

    Of such windows of a document with the same reference one is probed; the others are held against it.
    """
    rows: list[np.ndarray] = [np.zeros((0, 6), np.int64)]
    for (doc, key), hits in _hits(found):
        parsed = factors(hits)
        lone = hits[np.isin(hits[:, 0], [f[0] for f in parsed if f[4] == 1])]
        if not len(lone):
            continue
        _, one = np.unique(lone[:, 1:], axis=0, return_index=True)
        lone = lone[one]
        of = np.broadcast_to(np.array([doc, key], np.int64), (len(lone), 2))
        rows.append(np.hstack([of, lone[:, :1], of, lone[:, :1]]))
        rows.append(np.hstack([lone[:, 1:], of, lone[:, :1]]))
    all_ = np.concatenate(rows)
    columns = [_buckets(np.ascontiguousarray(all_[:, 0]), all_[:, 1].astype(np.int32), buckets), *all_.T]
    kinds = ["bucket", "doc", "key", "place", "tag_doc", "tag_key", "tag_place"]
    return pa.table({n: pa.array(np.ascontiguousarray(c), pa.int64() if n.endswith("doc") else pa.int32()) for n, c in zip(kinds, columns, strict=True)})


def _texts(packed: pa.Table) -> Iterator[tuple[int, int, int, bytes]]:
    """(doc_id, key, how often it stands, text) of a bucket."""
    for docs, keys, times, sizes, texts in zip(*(packed.column(n).to_pylist() for n in ("docs", "keys", "times", "sizes", "texts")), strict=True):
        ids, own, times = _read_documents(docs, keys, times)
        sizes = _unpack(sizes, "i4", len(ids))
        ends = np.cumsum(sizes, dtype=np.int64)
        data = _unpack(texts, "u1", int(ends[-1])).tobytes()
        for i, k, n, size, end in zip(ids.tolist(), own.tolist(), times.tolist(), sizes.tolist(), ends.tolist(), strict=True):
            yield i, k, n, data[end - size : end]


def _digests(packed: pa.Table, probes: pa.Table, window: int) -> pa.Table:
    """(tag, digest of the words) of the probed windows of a bucket's texts."""
    wanted: dict[tuple[int, int], list[tuple]] = {}
    for doc, key, *rest in zip(*(probes.column(n).to_pylist() for n in ("doc", "key", "place", "tag_doc", "tag_key", "tag_place")), strict=True):
        wanted.setdefault((doc, key), []).append(tuple(rest))
    out, done = [], set()
    for doc, key, _, text in _texts(packed) if wanted else ():
        if (doc, key) in wanted and (doc, key) not in done:
            done.add((doc, key))
            words = text.split()
            out += [(*tag, hashlib.sha256(b" ".join(words[place : place + window])).hexdigest()) for place, *tag in wanted[doc, key]]
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("tag_doc", "tag_key", "tag_place", "digest"), columns, (pa.int64(), pa.int32(), pa.int32(), pa.string()), strict=True)})


def _packs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Texts for each bucket: (bucket, ids, keys, how often each stands, sizes, texts)."""
    held: dict[tuple[int | None, int, bytes], int] = {}
    size = 0

    def rows() -> pa.RecordBatch:
        ids = np.array([_LAST if d is None else d for d, _, _ in held], np.int64)
        keys = np.array([k for _, k, _ in held], np.int32)
        bucket = _buckets(ids, keys, buckets)
        texts, times = [t for _, _, t in held], np.array([-n if d is None else n for (d, _, _), n in held.items()], np.int32)
        out = []
        order = np.argsort(bucket, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            mine = [texts[i] for i in own]
            docs, keyed, counts = _documents(ids[own], keys[own], times[own])
            out.append((int(bucket[own[0]]), docs, keyed, counts, _pack(np.array([len(t) for t in mine], np.int32)), _pack(np.frombuffer(b"".join(mine), np.uint8))))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int32(), *[pa.binary()] * 5], strict=True)], names=["bucket", "docs", "keys", "times", "sizes", "texts"])

    for batch, lo in ((b, lo) for b in batches for lo in range(0, len(b), 256)):
        for doc_id, text, key in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns), strict=True):
            row = (doc_id, key, (text or "").encode())
            size += 0 if row in held else len(row[2]) + 100
            held[row] = held.get(row, 0) + 1
            if size >= _PACK_BYTES:
                yield rows()
                held, size = {}, 0
    if held:
        yield rows()


def factors(hits: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(first word, past the last word, reference doc_id, place in it, windows) of each factor, from the left.

    hits: rows (place, reference doc_id, key, place) in order of place. A factor is extended while
    the next window is found at the next place of its reference.
    """
    if not len(hits):
        return []
    goes_on = (np.diff(hits[:, 0]) == 1) & (np.diff(hits[:, 3]) == 1) & (np.diff(hits[:, 1]) == 0) & (np.diff(hits[:, 2]) == 0)
    first = np.flatnonzero(np.r_[True, ~goes_on])
    sizes = np.diff(np.r_[first, len(hits)])
    return [(p, p + n - 1 + window, doc, at, n) for (p, doc, _, at), n in zip(hits[first].tolist(), sizes.tolist(), strict=True)]


def remove(text: bytes, spans: list[tuple]) -> tuple[int, list[bytes]]:
    """(number of words, words outside all spans) of a text in UTF-8; spans (first, past the last, ...) may overlap."""
    words = text.split()
    kept, at = [], 0
    for lo, hi, *_ in spans:
        kept += words[at:lo]
        at = max(at, hi)
    return len(words), kept + words[at:]


def _confirmed(text: bytes, hits: np.ndarray, refuted: set[int], window: int) -> np.ndarray:
    """The hits without windows that were refuted, or whose words differ from a lone one of the same reference."""
    lone = [f[0] for f in factors(hits, window) if f[4] == 1]
    by: dict[tuple, list[int]] = {}
    for row in hits[np.isin(hits[:, 0], lone)].tolist():
        by.setdefault(tuple(row[1:]), []).append(row[0])
    words, bad = text.split(), set(refuted)
    for same in by.values():
        bad.update(p for p in same[1:] if same[0] in refuted or words[p : p + window] != words[same[0] : same[0] + window])
    return hits[~np.isin(hits[:, 0], sorted(bad))] if bad else hits


def _cut(packed: pa.Table, found: pa.Table, window: int) -> pa.Table:
    """One bucket: its texts without the words that factors cover, each distinct row once with its number."""
    refuted: dict[tuple[int, int], set[int]] = {}
    for doc, key, place in zip(*(found.column(n).to_pylist() for n in ("tag_doc", "tag_key", "tag_place")), strict=True):
        if place is not None:
            refuted.setdefault((doc, key), set()).add(place)
    hits = dict(_hits(found.filter(found.column("docs").is_valid())))
    out = []
    for i, k, n, text in _texts(packed):
        own = hits.get((i, k))
        spans = factors(_confirmed(text, own, refuted.get((i, k), set()), window), window) if own is not None else []
        total, kept = remove(text, spans)
        joined = b" ".join(kept)
        out.append((None if n < 0 else i, total, total - len(kept), joined.decode(), hashlib.sha256(joined).hexdigest(), [{"first": a, "end": b, "ref_doc": r, "ref_first": p} for a, b, r, p, _ in spans], abs(n)))
    columns = list(zip(*out, strict=True)) if out else [()] * 7
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("ref_doc", pa.int64()), ("ref_first", pa.int32())])), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans", "times"])


_OUT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<first: int, end: int, ref_doc: long, ref_first: int>>, times long"


def deduplicated(docs: DataFrame, window: int = WINDOW, blocks: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, kept_sha256, spans) for each row of ``docs``.

    spans: first word and past the last of each factor, its reference document and the place in it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("key"))
    if blocks is None:
        total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        blocks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK_BYTES))
    known = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(_LAST)))
    sent = known.mapInArrow(lambda batches: _send(batches, window, blocks), _SENT)
    found = stage(sent.groupBy("block").applyInArrow(lambda t: _settle(t, blocks), _FOUND), "substring-found")
    packed = rows.mapInArrow(lambda batches: _packs(batches, blocks), _PACKED)
    probes = found.groupBy("bucket").applyInArrow(lambda t: _lone(t, blocks), _PROBES)
    seen = packed.groupBy("bucket").cogroup(probes.groupBy("bucket")).applyInArrow(lambda texts, asked: _digests(texts, asked, window), _SEEN)
    tag = ["tag_doc", "tag_key", "tag_place"]
    differing = seen.groupBy(*tag).agg(F.min("digest").alias("a"), F.max("digest").alias("b")).filter("a <> b").select(*tag)
    refuted = differing.mapInArrow(lambda batches: _to_buckets(batches, blocks), "bucket int, tag_doc long, tag_key int, tag_place int")
    both = packed.groupBy("bucket").cogroup(found.unionByName(refuted, allowMissingColumns=True).groupBy("bucket"))
    cut = both.applyInArrow(lambda texts, places: _cut(texts, places, window), _OUT)
    # a row that stands often comes back in parts, so that no task holds all of them
    parts = cut.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / _REPEATS))))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(_REPEATS).cast("long"), F.col("times") - F.col("_part") * _REPEATS)))
    return parts.withColumn("_each", each).select("doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans")


def _to_buckets(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bucket = _buckets(batch.column(0).to_numpy(), batch.column(1).to_numpy(), buckets)
        yield pa.RecordBatch.from_arrays([pa.array(bucket), *batch.columns], names=["bucket", *batch.schema.names])
