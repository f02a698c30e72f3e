"""LM scoring: a gated recurrent network over frequent words and classes of rare ones.

Counts of all tokens of all training documents give the unigram base score, the head vocabulary
(the ``head`` most frequent words, modelled one by one), and the distribution within each class of
rare words. The network's weights are trained on every token of every training document once: a
hash of doc_id and text deals the documents to rounds and, within each, to groups of about
``group_tokens`` tokens. The groups of a round train from the same weights, which are then averaged by
their tokens, ``BUNDLE`` of them at a time, so no task holds more than that many. There are as many rounds
as the cube root of the number of groups, within ``ROUNDS``. Rounds and groups depend on the documents
alone, not on the cluster.

A document's score is the log10 probability of all its tokens in order. The network pass looks up
the most frequent words, about ``known``, in a table sent to every task; the counts of all
other words are joined to the documents that hold them.

Words are told apart by 64-bit hashes. Cases: a null or wordless text is its end token alone;
without training documents every token is unknown; repeated rows count each in training and give
repeated result rows; a null doc_id is in training; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.llm.gru import HIDDEN, Network
from carrel.sources.staging import fresh_dir, stage
from carrel.llm.words import Chunk, chunks, mix

HEAD = 1024
KNOWN = 1 << 17
RARE = 32
ROUNDS = (4, 16)  #: at least and at most; each training document is in one of them
GROUP_TOKENS = 1 << 19
END = 1
_MERGE = 1 << 21
BUNDLE = 64  #: of weights that one task averages
_PARTS = 32  #: of the weights, averaged apart from one another
_LEVELS = 16  #: of counts for each doubling; words are held by levels, the most frequent first


def _sequence(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, rare class, bounds) of all tokens, each document's end included."""
    n, docs = len(chunk.start), np.arange(chunk.n_docs)
    bounds = chunk.bounds + np.arange(chunk.n_docs + 1)
    tokens = np.full(n + chunk.n_docs, END, np.uint64)
    rare = np.zeros(len(tokens), np.int16)
    at = np.arange(n) + np.repeat(docs, np.diff(chunk.bounds))
    tokens[at] = chunk.hashes(lower=True)
    rare[at] = chunk.data[chunk.end - 1] % RARE
    return tokens, rare, bounds


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, rare, c): a row for each distinct token of a task, or of part of it."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tokens, rare, c = map(np.concatenate, zip(*held, strict=True))
        found, first, number = np.unique(tokens, return_index=True, return_inverse=True)
        return found, rare[first], np.bincount(number, c).astype(np.int64)

    def rows(found) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64)), pa.array(found[1]), pa.array(found[2])], names=["token", "rare", "c"])

    for batch in batches:
        for chunk in chunks(batch.column(0)):
            tokens, rare, _ = _sequence(chunk)
            found, first, c = np.unique(tokens, return_index=True, return_counts=True)
            held.append((found, rare[first], c))
            if sum(len(h[0]) for h in held) > _MERGE:
                held = [merged()]
                if len(held[0][0]) > _MERGE // 2:
                    yield rows(held[0])
                    held = []
    if held:
        yield rows(merged())


class Vocabulary:
    """The most frequent words with their counts, looked up by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray, n_head: int):
        """tokens by falling count; the first n_head make up the head."""
        self.counts, self.n_head = counts, min(n_head, len(tokens))
        self.order = np.argsort(tokens)
        self.sorted = tokens[self.order]
        self.bits = np.uint64(64 - 20)
        self.near = np.searchsorted(self.sorted, np.arange(1 << 20, dtype=np.uint64) << self.bits)

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """The rank by count of each token, -1 for those that aren't here."""
        found = np.full(len(tokens), -1, np.int64)
        if not len(self.sorted):
            return found
        at = self.near[tokens >> self.bits]
        open_ = np.arange(len(tokens))
        while len(open_):  # the few entries of one prefix, in order
            own, wanted = self.sorted[np.minimum(at, len(self.sorted) - 1)], tokens[open_]
            hit = own == wanted
            found[open_[hit]] = self.order[at[hit]]
            more = (own < wanted) & (at < len(self.sorted) - 1)
            open_, at = open_[more], at[more] + 1
        return found


class Model:
    def __init__(self, vocabulary: Vocabulary, network: Network, rare_mass: np.ndarray, train_tokens: int, distinct: int):
        self.vocabulary, self.network = vocabulary, network
        self.rare_log = np.log10(rare_mass)
        self.train_tokens = train_tokens
        self.base_log = np.log10(train_tokens + 0.5 * (distinct + 1))
        self.count_log = np.log10(vocabulary.counts + 0.5)

    def ids(self, rank: np.ndarray, rare: np.ndarray) -> np.ndarray:
        head = (rank >= 0) & (rank < self.vocabulary.n_head)
        return np.where(head, rank, self.vocabulary.n_head + rare)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


_IDS = "round int, group int, key long, ids binary"
_WEIGHTS = "part int, group int, tokens long, weights binary"


def fit(docs: DataFrame, keep: Column | None = None, head: int = HEAD, known: int = KNOWN, rounds: tuple[int, int] = ROUNDS, hidden: int = HIDDEN, group_tokens: int = GROUP_TOKENS) -> tuple[Model, DataFrame]:
    """(model, table of the counts (token, c) of all words that the model doesn't hold).

    Of the first count level that ``known`` has no room for, about as many words as it has are held.
    """
    spark = docs.sparkSession
    keep = ~held_out(F.col("doc_id")) if keep is None else keep
    training = docs.filter(keep)
    counted = training.select("text").mapInArrow(_count, "token long, rare short, c long")
    words = stage(counted.groupBy("token").agg(F.min("rare").alias("rare"), F.sum("c").alias("c")), "lm-words")
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    level = F.floor(F.log2("c") * _LEVELS).cast("int")
    sizes = sorted(words.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect(), reverse=True)
    least, cut, room = 1 << 20, 0, known
    for r in sizes:
        if r.n > room:  # of the first level that doesn't fit, the share that does, by hash
            cut = (room << 20) // r.n
            break
        least, room = r.level, room - r.n
    below = max((r.level for r in sizes if r.level < least), default=-1)
    kept = (level >= least) | ((level == below) & (F.pmod("token", F.lit(1 << 20)) < cut))
    top = words.filter(kept).toPandas().sort_values(["c", "token"], ascending=[False, True])
    tokens = top["token"].to_numpy(np.int64).view(np.uint64)
    vocabulary = Vocabulary(tokens, top["c"].to_numpy(np.int64), head)
    head_counts = vocabulary.counts[: vocabulary.n_head]
    mass = np.full(RARE, 0.5)
    for r in words.groupBy("rare").agg(F.sum(F.col("c") + 0.5).alias("mass")).collect():
        mass[r.rare] += r.mass
    np.add.at(mass, top["rare"].to_numpy(np.int64)[: vocabulary.n_head], -(head_counts + 0.5))
    mass = np.maximum(mass, 0.5)
    model = Model(vocabulary, Network(head_counts, mass, hidden), mass, int(n), int(v))
    rounds, groups = dealt(int(n), rounds, group_tokens)
    sent = spark.sparkContext.broadcast(model)
    numbered = training.select(F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(lambda batches: _numbered(batches, sent.value, rounds, groups), _IDS)
    path = fresh_dir(spark, "lm-ids")
    numbered.write.partitionBy("round").parquet(path)  # a round reads its own files alone
    numbered = spark.read.schema(_IDS).parquet(path)
    for i in range(rounds):
        trained = numbered.filter(F.col("round") == i).groupBy("group").applyInArrow(_trainer(spark.sparkContext.broadcast(model.network)), _WEIGHTS)
        parts = averaged(trained, groups).collect()  # one network, whatever the input
        if parts:
            model.network.load(np.concatenate([np.frombuffer(r.weights, np.float32) for r in sorted(parts, key=lambda r: r.part)]))
    return model, words.filter(~kept).select("token", "c")


def dealt(tokens: int, rounds: tuple[int, int] = ROUNDS, group_tokens: int = GROUP_TOKENS) -> tuple[int, int]:
    """(rounds, groups in each) for so many training tokens."""
    n = min(max(int(np.cbrt(tokens / group_tokens)), rounds[0]), rounds[1])
    return n, max(1, tokens // n // group_tokens)


def averaged(trained: DataFrame, groups: int) -> DataFrame:
    """(part, group, tokens, weights): one row for each part, averaged over all groups by their tokens."""
    while True:
        bundle = F.floor(F.col("group") / BUNDLE).cast("int").alias("group")
        trained = trained.select("part", bundle, "tokens", "weights").groupBy("part", "group").applyInArrow(_average, _WEIGHTS)
        groups = -(-groups // BUNDLE)
        if groups <= 1:
            return trained


def _numbered(batches: Iterator[pa.RecordBatch], model: Model, rounds: int, groups: int) -> Iterator[pa.RecordBatch]:
    """(round, group, key, ids) of each training document."""
    for batch in batches:
        for chunk in chunks(batch.column(1)):
            tokens, rare, bounds = _sequence(chunk)
            data = model.ids(model.vocabulary.find(tokens), rare).astype("<i4").tobytes()
            key = batch.column(0).slice(chunk.first, chunk.n_docs)
            dealt = mix(key.to_numpy().view(np.uint64)) % np.uint64(rounds * groups)
            ids = [data[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array((dealt % np.uint64(rounds)).astype(np.int32)), pa.array((dealt // np.uint64(rounds)).astype(np.int32)), key, pa.array(ids, pa.binary())], names=["round", "group", "key", "ids"])


def _trainer(held: Broadcast) -> Callable[[pa.Table], pa.Table]:
    return lambda rows: _train(rows, held.value)


def _train(rows: pa.Table, network: Network) -> pa.Table:
    """The weights after one group of documents, which stand in an order of their own."""
    order = pc.sort_indices(rows, [("key", "ascending"), ("ids", "ascending")])
    used = network.train([np.frombuffer(x.as_buffer(), "<i4") for x in rows.column("ids").take(order)])
    parts, group = np.array_split(network.flat(), _PARTS), rows.column("group")[0].as_py()
    return pa.table({"part": pa.array(range(_PARTS), pa.int32()), "group": pa.array([group] * _PARTS, pa.int32()), "tokens": pa.array([used] * _PARTS, pa.int64()), "weights": pa.array([w.tobytes() for w in parts], pa.binary())})


def _average(rows: pa.Table) -> pa.Table:
    """A part of the weights, averaged over a bundle by their tokens, always in the same order."""
    trained = sorted(zip(rows.column("tokens").to_pylist(), rows.column("weights").to_pylist(), strict=True))
    tokens = sum(n for n, _ in trained)
    weights = sum(np.frombuffer(w, np.float32).astype(np.float64) * n for n, w in trained) / tokens
    first = rows.slice(0, 1)
    return pa.table({"part": first.column("part"), "group": first.column("group"), "tokens": pa.array([tokens], pa.int64()), "weights": pa.array([weights.astype(np.float32).tobytes()], pa.binary())})


_PASS = "row long, doc_id long, n_tokens long, n_known long, base double, score double, rest array<long>, times array<int>"


def _pass(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Sums over the tokens that the model holds, and the others with how often they stand."""
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        lengths, ids, outs = [], [], []
        for chunk in chunks(batch.column(1)):
            tokens, rare, bounds = _sequence(chunk)
            rank = model.vocabulary.find(tokens)
            own = model.ids(rank, rare)
            doc = np.repeat(np.arange(chunk.n_docs), np.diff(bounds))
            seen = rank >= 0
            count_log = np.where(seen, model.count_log[np.maximum(rank, 0)], 0.0) if len(model.count_log) else np.zeros(len(tokens))
            is_rare = own >= model.vocabulary.n_head
            by_count = np.where(is_rare, count_log - model.rare_log[rare], 0.0)
            add = lambda x, doc=doc, n=chunk.n_docs: np.bincount(doc, x, n)
            missing = np.flatnonzero(~seen)
            order = missing[np.lexsort((tokens[missing], doc[missing]))]
            first = np.ones(len(order), bool)
            first[1:] = (doc[order][1:] != doc[order][:-1]) | (tokens[order][1:] != tokens[order][:-1])
            head = np.flatnonzero(first)
            times = np.diff(np.r_[head, len(order)]).astype(np.int32)
            edges = np.searchsorted(doc[order][head], np.arange(chunk.n_docs + 1)).astype(np.int32)
            outs.append((add(seen), add(count_log) - np.diff(bounds) * model.base_log, add(by_count), pa.ListArray.from_arrays(pa.array(edges), pa.array(tokens[order][head].view(np.int64))), pa.ListArray.from_arrays(pa.array(edges), pa.array(times))))
            lengths.append(np.diff(bounds))
            ids.append(own.astype(np.int16))
        if not outs:
            continue
        bounds = np.r_[0, np.cumsum(np.concatenate(lengths))]
        network = model.network.log_likelihood(np.concatenate(ids), bounds) / np.log(10)
        known, base, by_count, rest, times = zip(*outs, strict=True)
        n = len(batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(row, row + n)), batch.column(0), pa.array(np.diff(bounds)), pa.array(np.concatenate(known).astype(np.int64)), pa.array(np.concatenate(base)), pa.array(np.concatenate(by_count) + network), pa.concat_arrays(rest), pa.concat_arrays(times)],
            names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rest", "times"],
        )
        row += n


def score(docs: DataFrame, model: Model, rest: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    passed = stage(rows.mapInArrow(lambda batches: _pass(batches, held.value), _PASS), "lm-pass")
    asked = passed.select("row", F.explode(F.arrays_zip("rest", "times")).alias("t")).select("row", F.col("t.rest").alias("token"), F.col("t.times").alias("times"))
    counted = asked.join(rest, "token", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    log = F.sum(F.col("times") * F.log10(F.col("c") + 0.5))
    added = counted.groupBy("row").agg(log.alias("log"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more"))
    whole = passed.select("row", "doc_id", "n_tokens", "n_known", "base", "score").join(added, "row", "left")
    log, more = F.coalesce("log", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return whole.select("doc_id", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"), (F.col("base") + log).alias("base_score"), (F.col("score") + log).alias("score"))
