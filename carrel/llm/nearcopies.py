"""Near copies: SimHash ball hashing over blocks of wide fingerprints, verified by exact similarity.

Two documents are near copies if the Jaccard similarity of their sets of five-word shingles, A-Z
lower-cased, is at least the threshold (0.8); a text of fewer words has one shingle, all its words.
Groups are the connected components of these pairs.

Fingerprints of sets as similar as that differ in a known share of their bits (15 % at 0.8), too
many for one ball around 64 of them. So a fingerprint is as wide as ``blocks`` blocks of ``width``
bits, and pairs are sought that differ in at most two bits of any block: each value of a block
emits all variants within one bit of it, which meet in a shuffle. ``shape`` derives width and
blocks from the number of documents and the share of pairs at the threshold that are to be found
(``recall``, 0.999), so a document is brought to about as many others whatever the size of the input.

Documents of equal shingle sets are one class, and classes of an equal block value and size level
meet in one of them, by partial aggregates, so a group of copies counts once however large it is
and a variant's group holds at most as many values as a ball. Pairs that meet are kept where whole
fingerprints fit the threshold, and then verified on the whole shingle sets of their texts. First
each value meets only the one that stands for its variant's group, another one in each block, and
each class is verified with the smallest few it met, which joins most of a group. Then values meet once
more, and all pairs of them that are still apart are verified, those that the few left out among them,
but for pairs of two crowded classes, which are settled by then.

**Crowded classes.** In a family of texts below the threshold (pages of one template) many classes have
one block value, and only one of them stands for it. Bits can't tell such a family's pairs from near copies
without comparing most of them. So a class that some other one stands for in more than one of ``_SHARE`` blocks, beside
a different component, is crowded, and crowded classes meet a second time by their shingles, exactly: a prefix
filter over whole sets, in order from the shingles that fewest of them have, brings together all pairs that can reach the
threshold and are of different components, however many have a shingle. A family below the threshold costs little: what its
members all have stands behind what they have alone, beyond the prefix of the smaller set.

Cases: texts without words are one class, and so one group; a null doc_id stands after all others;
classes and shingles are told apart by 64-bit hashes; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.llm.components import connected
from carrel.llm.decontaminate import needed
from carrel.llm.words import chunks, mix
from carrel.sources.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
RADIUS = 2  #: bits of a block; every value emits all variants within half of it
SPARE_BITS = 8  #: of a block, beyond those that number the documents
GROUP_VALUES = 1 << 20  #: of one block, that a task brings together, about
_VARIANTS = 1 << 19  #: that it makes of them at a time
_SHARE = 8
_PART = 8  #: crowded classes that a shingle brings together before it does all, about
_TALLIED = 1 << 18  #: counts of shingles' hashes, by which those of crowded classes are put in order
_FIRST = 8  #: of the smallest classes that one met, that are compared with it before all others
_LEVEL = 0.05  #: sizes of a level differ by no more than this
_CHUNK_BYTES = 1 << 19
_ROWS = 512  #: that a task works on at a time


@dataclass(frozen=True)
class Shape:
    width: int  #: bits of a block
    blocks: int
    words: int  #: of 64 bits, that hold all blocks
    most: int  #: bits in which whole fingerprints of near copies differ at most


def shape(n_docs: int, similarity: float = SIMILARITY, recall: float = RECALL) -> Shape:
    """Blocks that find the share ``recall`` of pairs at the threshold among so many documents."""
    p = math.acos(min(1.0, 2 * similarity / (1 + similarity))) / math.pi
    width = max(16, math.ceil(math.log2(max(n_docs, 2))) + SPARE_BITS)
    missed = 1 - sum(math.comb(width, i) * p**i * (1 - p) ** (width - i) for i in range(RADIUS + 1))
    blocks = max(1, math.ceil(math.log(1 - recall) / math.log(missed))) if missed > 0 else 1
    words = -(-width * blocks // 64)
    return Shape(width, blocks, words, math.ceil(64 * words * p + 4 * math.sqrt(64 * words * p * (1 - p))))


def _sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingle hashes) of each text."""
    for chunk in chunks(texts, _CHUNK_BYTES):
        hashed = chunk.hashes(lower=True)
        count = np.diff(chunk.bounds)
        first, grams = chunk.windows(hashed, k)
        edges = np.searchsorted(first, chunk.bounds)
        short = {size: chunk.windows(hashed, size) for size in set(count[count < k].tolist()) if size}
        for i, n in enumerate(count.tolist()):
            if n >= k:
                own = grams[edges[i] : edges[i + 1]]
            elif n:
                at, found = short[n]
                own = found[np.searchsorted(at, chunk.bounds[i])][None]
            else:
                own = np.zeros(0, np.uint64)
            yield chunk.first + i, np.unique(own)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, len(batch), _ROWS):
            yield batch.slice(lo, _ROWS)


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def _class(grams: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes(), 7)).astype(np.int64))


def _tally(grams: np.ndarray) -> np.ndarray:
    return (mix(grams.view(np.uint64)) & np.uint64(_TALLIED - 1)).astype(np.int64)


def fingerprint(grams: np.ndarray, words: int) -> np.ndarray:
    """``words`` times 64 bits: each is 1 if it is in over half of the shingles' hashes."""
    salt = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(64 * words, np.int64)
    for lo in range(0, len(grams), 255):  # sums of 255 bits fit a byte
        hashed = mix(grams[lo : lo + 255, None] + salt)
        counts += np.unpackbits(hashed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(grams), bitorder="little").view(np.uint64)


def _sketches(docs: DataFrame, k: int, form: Shape) -> DataFrame:
    """(key, doc_id, class, n, fp) of each document; key: a hash of doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            classes, sizes, prints = [], [], []
            for _, grams in _sets(batch.column(2), k):
                classes.append(_class(grams))
                sizes.append(len(grams))
                prints.append(fingerprint(grams, form.words))
            flat = np.concatenate(prints).view(np.int64)
            edges = np.arange(0, len(flat) + 1, form.words, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(classes, pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(edges), pa.array(flat))], names=["key", "doc_id", "class", "n", "fp"])

    return docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "key long, doc_id long, class long, n int, fp array<long>")


def _blocks(classes: DataFrame, form: Shape) -> DataFrame:
    """(block, value, level, class, rank): a row for each class and block; rank: an order of its own for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            prints = batch.column(2).flatten().to_numpy().view(np.uint8).reshape(len(batch), -1)
            bits = np.unpackbits(prints, axis=1, bitorder="little")
            own = batch.column(0).to_numpy()
            level = np.floor(np.log(batch.column(1).to_numpy()) / math.log1p(_LEVEL)).astype(np.int32)
            for block in range(form.blocks):
                part = bits[:, block * form.width : (block + 1) * form.width].astype(np.int64)
                value = part @ (np.int64(1) << np.arange(form.width, dtype=np.int64))
                rank = mix(own.view(np.uint64) + np.uint64(block)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block, np.int32)), pa.array(value), pa.array(level), pa.array(own), pa.array(rank)], names=["block", "value", "level", "class", "rank"])

    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return classes.select("class", "n", "fp").repartition(tasks, "class").mapInArrow(run, "block int, value long, level int, class long, rank long")


def _window(similarity: float) -> int:
    """By how many levels the sizes of near copies differ at most."""
    return math.ceil(-math.log(similarity) / math.log1p(_LEVEL)) + 1


def _paired(block: int, part: int, value: np.ndarray, level: np.ndarray, owner: np.ndarray, component: np.ndarray, settled: np.ndarray, low: int, window: int, stars: bool) -> np.ndarray:
    """Rows (a, b), a < b: owners of different components whose values share a variant in one part of a block.

    The part is the bits of a variant above the lowest ``low``; it is taken in smaller ones, so that
    a bounded number of variants is held. Pairs of two settled owners are left out. A value stands at its own variants of a smaller part, or,
    from a part that differs in one bit, at its only variant there. stars: of each variant's group
    only pairs with the first, by an order of each block.
    """
    rank = mix(owner.view(np.uint64) + np.uint64(block))
    deeper = min(low, max(0, math.ceil(math.log2(max(1, len(value) * (low + 1) / _VARIANTS)))))
    low -= deeper
    ball = np.r_[np.int64(0), np.int64(1) << np.arange(low, dtype=np.int64)]
    out = [np.zeros((0, 2), np.int64)]
    for sub in range(part << deeper, (part + 1) << deeper):
        off = (value >> low) ^ sub
        own, visitors = np.flatnonzero(off == 0), np.flatnonzero((off != 0) & (off & (off - 1) == 0))
        variant = np.concatenate([(value[own, None] ^ ball).ravel(), (value[visitors] & ((np.int64(1) << low) - 1)) | (np.int64(sub) << low)])
        which = np.concatenate([np.repeat(own, len(ball)), visitors])
        order = np.lexsort((rank[which], variant))
        variant, which = variant[order], which[order]
        heads = np.flatnonzero(np.r_[True, variant[1:] != variant[:-1]]) if len(variant) else np.zeros(0, np.int64)
        place = np.arange(len(variant)) - np.repeat(heads, np.diff(np.r_[heads, len(variant)]))
        for lag in range(1, int(place.max(initial=0)) + 1):
            at = np.flatnonzero(place == lag if stars else place >= lag)
            x, y = which[at - lag], which[at]
            fits = (np.abs(level[x] - level[y]) <= window) & (component[x] != component[y]) & ~(settled[x] & settled[y])
            out.append(np.unique(np.sort(np.stack([owner[x[fits]], owner[y[fits]]], axis=1), axis=1), axis=0))
    return np.unique(np.concatenate(out), axis=0)


def _met(rows: DataFrame, values: DataFrame, n_docs: int, form: Shape, similarity: float, stars: bool) -> DataFrame:
    """(a, b), a < b: pairs of classes of different components that differ in at most two bits of a block.

    rows: (block, value, level, class, component, settled); values: (block, value, level, owner, component, settled, n).
    stars: only with what stands for a variant's group; of each b the smallest few.
    """
    home = ["block", "value", "level"]
    same = rows.join(values.filter("n > 1").select(*home, "owner", F.col("component").alias("_c"), F.col("settled").alias("_s")), home).filter("component <> _c and not (settled and _s)")
    same = same.select(F.least("class", "owner").alias("a"), F.greatest("class", "owner").alias("b"))
    top = min(form.width - 1, max(0, math.ceil(math.log2(max(1, n_docs / GROUP_VALUES)))))
    low = form.width - top
    part = F.shiftright("value", low)
    flips = [part.bitwiseXOR(F.lit(1 << i).cast("long")) for i in range(top)]
    window = _window(similarity)

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        columns = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("value", "level", "owner", "component", "settled"))
        pairs = _paired(key[0].as_py(), key[1].as_py(), *columns, low, window, stars)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    sent = values.select("block", F.explode(F.array(part, *flips)).alias("part"), "value", "level", "owner", "component", "settled")
    pairs = same.unionByName(sent.groupBy("block", "part").applyInArrow(meet, "a long, b long"))
    if not stars:
        return pairs.distinct()
    few = F.slice(F.array_sort(F.collect_set("a")), 1, _FIRST)
    return pairs.groupBy("b").agg(few.alias("_a")).select(F.explode("_a").alias("a"), "b")


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, similarity: float, k: int) -> DataFrame:
    """The pairs (a, b) of classes whose shingle sets are as similar as that, by the texts of their first rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            keep = []
            for (_, x), (_, y) in zip(_sets(batch.column(2), k), _sets(batch.column(3), k), strict=True):
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(shared >= needed(len(x) + len(y) - shared, similarity))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    ends = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    wanted = classes.join(ends, "class").select("class", F.col("first.key").alias("_key"))
    rows = docs.select("text", _key().alias("_key")).join(wanted, "_key").select("class", "text")
    texts = stage(rows.dropDuplicates(["class"]), "near-texts")
    both = pairs.join(texts.select(F.col("class").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("class").alias("b"), F.col("text").alias("y")), "b")
    return stage(both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long"), "near-verified")


def _crowded(told: DataFrame, owned: DataFrame, form: Shape) -> DataFrame:
    """(class): those that another one stands for in many blocks, in values that hold several components."""
    home = ["block", "value", "level"]
    mixed = told.groupBy(*home).agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high")
    owners = owned.filter("n > 1").select(*home, "owner").join(mixed.select(*home), home)
    lossy = told.join(owners, home).filter("class <> owner")
    return lossy.groupBy("class").agg(F.count("*").alias("_n")).filter(F.col("_n") > form.blocks // _SHARE).select("class")


def _by_shingles(crowded: DataFrame, docs: DataFrame, classes: DataFrame, links: DataFrame, similarity: float, k: int, label: DataFrame | None = None, rest: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links that join what ``links`` does, and all near copies of different components among the crowded classes, which meet by prefixes.

    A class's shingles are in order from those that fewest crowded classes have, counted by a hash of ``_TALLIED`` values: any one
    order for all classes loses no pair, and this one spares what a family has in common. If two sets are as similar, the smaller one's
    first shingles, less what it must share with a set of its own size, hold one of the larger one's first, less what that must share at all.
    What many have meets in parts of a few classes first, which joins most of a family, and then whole.
    label: the components of ``links``; rest: more pairs, by the components before the last meeting, that are verified with its own.
    """

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = [grams.view(np.int64) for _, grams in _sets(batch.column(1), k)]
            edges = np.cumsum([0, *map(len, found)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found)))], names=["class", "g"])

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_TALLIED, np.int64)
        for batch in batches:
            total += np.bincount(_tally(batch.column(0).flatten().to_numpy()), minlength=_TALLIED)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["tally", "n"])

    firsts = classes.join(crowded, "class").select("class", F.col("first.key").alias("_key"))
    texts = docs.select("text", _key().alias("_key")).join(firsts, "_key").dropDuplicates(["class"]).select("class", "text")
    sets = stage(texts.mapInArrow(shingled, "class long, g array<long>"), "near-sets")
    counts = np.zeros(_TALLIED, np.int64)
    for at, n in sets.select("g").mapInArrow(tallied, "tally long, n long").groupBy("tally").agg(F.sum("n")).collect():
        counts[at] = n
    shared_counts = sets.sparkSession.sparkContext.broadcast(counts)

    def fronts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            own, grams, sizes, places = batch.column(0).to_numpy(), [], [], []
            for row in batch.column(1):
                g = row.values.to_numpy()
                count = shared_counts.value[_tally(g)]
                order = np.lexsort((g, count))[: len(g) - math.ceil(len(g) * similarity - 1e-9) + 1]
                places.append(np.flatnonzero(count[order] > 1))  # one that no other class has meets none
                grams.append(g[order[places[-1]]])
                sizes.append(len(g))
            times = [len(x) for x in places]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(grams)), pa.array(np.repeat(own, times)), pa.array(np.repeat(np.array(sizes, np.int32), times)), pa.array(np.concatenate(places).astype(np.int32))], names=["gram", "class", "n", "at"])

    share = 2 * similarity / (1 + similarity)
    prefixes = stage(sets.mapInArrow(fronts, "gram long, class long, n int, at int"), "near-prefixes")
    shared = F.ceil((F.col("_n") + F.col("n")) * F.lit(share / 2) - 1e-9)
    fits = (F.struct("_n", "_class") < F.struct("n", "class")) & (F.col("_component") != F.col("component")) & (F.least(F.col("_n") - F.col("_at"), F.col("n") - F.col("at")) >= shared)
    label = _labelled(links) if label is None else label
    for size in (_PART, None):
        told = prefixes.join(label, "class", "left").withColumn("component", F.coalesce("component", "class"))
        parts = F.lit(1).cast("long") if size is None else F.floor(F.count("*") / size) + 1
        mixed = told.groupBy("gram").agg(parts.alias("_parts"), F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high").select("gram", "_parts")
        told = told.join(mixed, "gram").withColumn("part", F.pmod(F.xxhash64("gram", "class", F.lit(size or 0)), F.col("_parts")))
        told = stage(told.select("gram", "part", "class", "n", "at", "component"), "near-told")
        small = told.filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * F.lit(share) - 1e-9))
        small = small.select("gram", "part", *(F.col(c).alias(f"_{c}") for c in ("class", "n", "at", "component")))
        pairs = told.join(small, ["gram", "part"]).filter(fits).select(F.least("_class", "class").alias("a"), F.greatest("_class", "class").alias("b"))
        if size is None and rest is not None:
            pairs = pairs.unionByName(rest(label))
        found = _verified(stage(pairs.distinct(), "near-crowded-pairs"), docs, classes, similarity, k)
        if size is None:
            return links.unionByName(found)
        label = _labelled(links.unionByName(found))
        links = _stars(label)


def _stars(label: DataFrame) -> DataFrame:
    """Links (a, b) that have these components: of each class to the one that names its component."""
    return label.select(F.col("class").alias("a"), F.col("component").alias("b"))


def _labelled(links: DataFrame) -> DataFrame:
    """(class, component) of what links (a, b) join."""
    return stage(connected(links).withColumnRenamed("node", "class"), "near-labels")


def _fitting(pairs: DataFrame, classes: DataFrame, form: Shape) -> DataFrame:
    """The pairs whose whole fingerprints differ as little as those of near copies do."""
    left = classes.select(F.col("class").alias("a"), F.col("fp").alias("x"))
    right = classes.select(F.col("class").alias("b"), F.col("fp").alias("y"))
    differing = sum((F.bit_count(F.col("x")[i].bitwiseXOR(F.col("y")[i])) for i in range(form.words)), F.lit(0))
    return pairs.join(left, "a").join(right, "b").filter(differing <= form.most).select("a", "b")


def groups(docs: DataFrame, similarity: float = SIMILARITY, k: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """(key, doc_id, first) for each row of ``docs``; first: (missing, doc_id, key) of its group's first row."""
    n_docs = docs.count()
    form = shape(n_docs, similarity, recall)
    made = stage(_sketches(docs, k, form), "near-sketches")
    own = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    classes = stage(made.groupBy("class").agg(F.min(own).alias("first"), F.min("n").alias("n"), F.min("fp").alias("fp")), "near-classes")
    rows = stage(_blocks(classes.filter("n > 0"), form), "near-blocks")
    home = ["block", "value", "level"]
    values = stage(rows.groupBy(*home).agg(F.min(F.struct("rank", "class")).alias("top"), F.count("*").alias("n")).select(*home, F.col("top.class").alias("owner"), "n"), "near-values")
    none = F.lit(False).alias("settled")
    met = _met(rows.select("*", F.col("class").alias("component"), none), values.select("*", F.col("owner").alias("component"), none), n_docs, form, similarity, stars=True)
    links = _verified(stage(_fitting(met, classes, form), "near-stars"), docs, classes, similarity, k)

    def told(label: DataFrame, settled: DataFrame) -> tuple[DataFrame, DataFrame]:
        known = label.join(settled.withColumn("_s", F.lit(True)), "class", "full_outer")
        about = lambda end: (F.coalesce("component", end).alias("component"), F.coalesce("_s", F.lit(False)).alias("settled"))
        mine = rows.join(known, "class", "left").select(*home, "class", *about("class"))
        return mine, values.join(known.withColumnRenamed("class", "owner"), "owner", "left").select(*home, "owner", "n", *about("owner"))

    label = _labelled(links)
    links = _stars(label)
    crowded = stage(_crowded(*told(label, label.select("class").limit(0)), form), "near-crowded")
    rest = lambda label: _fitting(_met(*told(label, crowded), n_docs, form, similarity, stars=False), classes, form)
    if crowded.isEmpty():
        links = links.unionByName(_verified(stage(rest(label), "near-rest"), docs, classes, similarity, k))
    else:
        links = _by_shingles(crowded, docs, classes, links, similarity, k, label, rest)
    joined = connected(links).withColumnRenamed("node", "class")
    found = classes.select("class", "first").join(joined, "class", "left").select("class", "first", F.coalesce("component", "class").alias("component"))
    smallest = found.groupBy("component").agg(F.min("first").alias("first"))
    named = stage(found.select("class", "component").join(smallest, "component").select("class", "first"), "near-named")
    return made.select("key", "doc_id", "class").join(named, "class").select("key", "doc_id", "first")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY, k: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest doc_id; rows of one id can be in several groups.

    Of rows that repeat the kept one in doc_id and text any one stays. Only these few are brought
    together; all others are found by their key alone.
    """
    first = groups(docs, similarity, k, recall).filter(F.col("key") == F.col("first.key"))
    name = "_key"
    while name in docs.columns:
        name += "_"
    kept = stage(first.groupBy(F.col("key").alias(name)).agg(F.count("*").alias("n")), "near-kept")
    keyed = docs.withColumn(name, _key())
    single = keyed.join(kept.filter("n = 1").select(name), name, "left_semi")
    repeated = keyed.join(kept.filter("n > 1").select(name), name, "left_semi").dropDuplicates([name])
    return single.unionByName(repeated).select(*docs.columns)
