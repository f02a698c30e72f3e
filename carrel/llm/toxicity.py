"""Toxic spans by a linear-chain conditional random field.

Labels mark documents; tokens get theirs from them. Among the features of a token (its folded word
and the prefixes of 4 to 8 bytes) those are kept that stand in at least ``least_docs`` toxic
documents of the sample and in toxic ones far more often than in others. A token of a toxic sample
document is toxic if one of its kept features is strong; every token of any other document is
clean. A two-state chain over all tokens, with weights for kept features at the token and its
neighbours, is then fit to these tokens by the exact likelihood gradient.

Scoring runs forward-backward over every whole text. The marginals give the offsets of toxic spans
and, summed and maximised, two inputs of a logistic document score, fit on the same sample.

The sample is bounded: at most ``sample`` labelled documents (parameter), half of each label where
there are enough; each counts by the share that its label has among all training rows, so scores
don't depend on the sample. The model holds at most ``max_features`` weights.

Cases: a null, empty or wordless text has no toxic token and gets the score of that; without toxic
documents in the sample every score is the prior; conflicting labels of one doc_id count by their
mean; a doc_id trains once, by one of its texts; rows with a null doc_id or label don't train; repeated rows give repeated result rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.llm.quality import label_weights, labelled_sample, training_rows
from carrel.llm.words import Chunk, chunks

SAMPLE = 6000
FLAG = 0.7
LEAST_DOCS = 4
STRONG = 2.5
MAX_FEATURES = 4096
_GROUP_TOKENS = 1 << 18  #: that training holds at a time, or one longer document
_SEGMENT = 512
_CONTEXT = 4.0  #: pull to zero of the weights of neighbours and transitions; 0.1 of a token's own
_PREFIXES = (4, 5, 6, 7, 8)
_EDGE = np.zeros(256, bool)
_EDGE[[ord(c) for c in ".,;:!?'\"()[]{}*#$%&|<>-_~"]] = True


def features(chunk: Chunk) -> list[np.ndarray]:
    """Hashes of each token's features: its word without outer punctuation, then its prefixes.

    A prefix as long as the word, or longer, is zero, which is no feature.
    """
    start, end = chunk.start.copy(), chunk.end.copy()
    for _ in range(4):
        end -= (end - start > 1) & _EDGE[chunk.data[end - 1]]
        start += (end - start > 1) & _EDGE[chunk.data[start]]
    out = [chunk.hashes(True, start, end)]
    for n in _PREFIXES:
        cut = np.minimum(start + n, end)
        out.append(np.where(end - start > n, chunk.hashes(True, start, cut) ^ np.uint64(n), np.uint64(0)))
    return out


def _packed_order(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences by falling length, and how many of them have a t-th token."""
    order = np.argsort(-lengths, kind="stable")
    top = int(lengths.max(initial=0))
    return order, np.searchsorted(-lengths[order], -np.arange(top), "left")


class Chain:
    """Forward-backward over two states for many sequences at once, step by step in time."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        self.order, self.active = _packed_order(lengths)
        self.first, self.last = bounds[:-1][self.order], bounds[1:][self.order] - 1

    def marginals(self, emission: np.ndarray, transition: np.ndarray, pairs: bool = False, weight: np.ndarray | None = None):
        """Probability of state 1 at each token; with pairs also expected transition counts and log Z.

        emission: score of state 1 over state 0 at each token; transition: 2 x 2 scores; weight: how
        much the transition to each token counts, 1 unless given.
        """
        n = len(emission)
        w = np.exp(transition)
        e = np.exp(np.clip(emission, -60, 60))
        forward, backward = np.empty(n), np.empty(n)  # state 1 over state 0
        log_z = 0.0
        for t, k in enumerate(self.active):
            at = self.first[:k] + t
            if t == 0:
                ratio = e[at]
                scale = np.ones(k)
            else:
                before = forward[at - 1]
                scale = w[0, 0] + w[1, 0] * before
                ratio = e[at] * (w[0, 1] + w[1, 1] * before) / scale
            forward[at] = ratio
            if pairs:
                log_z += np.log(scale).sum()
        for t, k in enumerate(self.active):
            at = self.last[:k] - t
            if t == 0:
                backward[at] = 1.0
            else:
                after = e[at + 1] * backward[at + 1]
                backward[at] = (w[1, 0] + w[1, 1] * after) / (w[0, 0] + w[0, 1] * after)
        odds = forward * backward
        p = odds / (1 + odds)
        if not pairs:
            return p
        log_z += np.log1p(forward[self.last[self.last >= self.first]]).sum()
        inner = np.ones(n, bool)
        inner[self.first[self.last >= self.first]] = False
        at = np.flatnonzero(inner)
        left, right = forward[at - 1], e[at] * backward[at]
        joint = np.stack([w[0, 0] * np.ones(len(at)), w[0, 1] * right, w[1, 0] * left, w[1, 1] * left * right])
        expected = (joint / joint.sum(axis=0) * (1.0 if weight is None else weight[at])).sum(axis=1).reshape(2, 2)
        return p, expected, log_z


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Lexicon, chain weights and document score; ``emission`` and ``score`` apply them."""

    def __init__(self, lexicon: np.ndarray, strong: np.ndarray, prior: float):
        order = np.argsort(lexicon)
        self.lexicon, self.strong, self.prior = lexicon[order], strong[order], prior
        n = len(lexicon)
        self.weights = np.zeros(n + 3)  # of features, bias, left and right neighbour
        self.weights[n] = -4.0
        self.transition = np.zeros((2, 2))
        self.document = np.array([-2.0, 1.0, 1.0])

    def lookup(self, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(token, number in the lexicon) of all kept features."""
        tokens, numbers = [], []
        for hashes in found:
            if not len(self.lexicon):
                break
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            hit = np.flatnonzero(self.lexicon[at] == hashes)
            tokens.append(hit)
            numbers.append(at[hit])
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *tokens]), np.concatenate([empty, *numbers])

    def _neighbours(self, marked: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the token before, and after, has a kept feature, inside its document."""
        left, right = np.zeros(len(marked)), np.zeros(len(marked))
        left[1:], right[:-1] = marked[:-1], marked[1:]
        used = bounds[:-1] < bounds[1:]
        left[bounds[:-1][used]] = 0
        right[bounds[1:][used] - 1] = 0
        return left, right

    def emission(self, tokens: np.ndarray, numbers: np.ndarray, n: int, bounds: np.ndarray) -> np.ndarray:
        marked = np.zeros(n)
        marked[tokens] = 1
        left, right = self._neighbours(marked, bounds)
        k = len(self.lexicon)
        out = np.full(n, self.weights[k]) + self.weights[k + 1] * left + self.weights[k + 2] * right
        np.add.at(out, tokens, self.weights[numbers])
        return out

    def fit(self, documents: list[tuple[int, int, np.ndarray, np.ndarray]], rounds: int = 60, weights: tuple[float, float] = (1.0, 1.0)) -> None:
        """documents: (label, number of tokens, token of each kept feature, the feature's number).

        Chain weights are fit to segments of ``_SEGMENT`` tokens, which together are all tokens of
        all documents, with a clean one before and after each, as a span is entered and left even
        where it is the whole document; document weights are fit to the marginals of whole documents. A bounded
        number of tokens is taken at a time; only kept features are held for all of them. weights: how
        much a document of label 0, and of label 1, counts.
        """
        k = len(self.lexicon)
        groups = [_Group(self, part, weights) for part in _groups([piece for y, n, tokens, numbers in documents for piece in _segments(y, n + 2, tokens + 1, numbers)])]
        seen = sum(g.pairs for g in groups)
        theta = np.r_[self.weights, self.transition.ravel()]
        pull = np.r_[np.full(k + 1, 0.1), np.full(6, _CONTEXT)]
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, rounds + 1):
            self.weights, self.transition = theta[: k + 3], theta[k + 3 :].reshape(2, 2)
            g = -pull * theta
            g[k + 3 :] += seen.ravel()
            for group in groups:
                at_tokens, transitions = group.gradient(self)
                g[: k + 3] += at_tokens
                g[k + 3 :] -= transitions.ravel()
            m, v = 0.8 * m + 0.2 * g, 0.95 * v + 0.05 * g * g
            theta = theta + 0.25 * (m / (1 - 0.8**i)) / (np.sqrt(v / (1 - 0.95**i)) + 1e-8)
        self.weights, self.transition = theta[: k + 3], theta[k + 3 :].reshape(2, 2)
        x, labels, each = [], [], []
        for part in _groups(documents):
            whole = _Group(self, part, weights)
            x.append(self._summary(whole.marginals(self), whole.bounds))
            labels.append(whole.labels)
            each.append(whole.each)
        x, labels, each = np.concatenate(x), np.concatenate(labels), np.concatenate(each)
        d = self.document
        for _ in range(200):  # Newton steps of a logistic regression
            q = _sigmoid(x @ d)
            h = (x * (each * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3)
            step = np.linalg.solve(h, x.T @ (each * (labels - q)) - 0.05 * d)
            d = d + step
            if np.abs(step).max() < 1e-9:
                break
        self.document = d

    @staticmethod
    def _summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A constant, the largest marginal and the logarithm of their sum, of each document."""
        n = len(bounds) - 1
        total = np.diff(np.r_[0, np.cumsum(p)][bounds])
        most = np.zeros(n)
        used = np.flatnonzero(bounds[:-1] < bounds[1:])
        if len(used):
            most[used] = np.maximum.reduceat(p, bounds[:-1][used])
        return np.stack([np.ones(n), most, np.log1p(np.maximum(total, 0))], axis=1)

    def apply(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """(score of each document, marginal of each token)."""
        n = len(chunk.start)
        if not len(self.lexicon):
            return np.full(chunk.n_docs, self.prior), np.zeros(n)
        tokens, numbers = self.lookup(features(chunk))
        p = Chain(chunk.bounds).marginals(self.emission(tokens, numbers, n, chunk.bounds), self.transition)
        return _sigmoid(self._summary(p, chunk.bounds) @ self.document), p


def _segments(label: int, n: int, tokens: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A document in pieces of ``_SEGMENT`` tokens; tokens is ascending."""
    for lo in range(0, n, _SEGMENT):
        a, b = np.searchsorted(tokens, (lo, lo + _SEGMENT))
        yield label, min(_SEGMENT, n - lo), tokens[a:b] - lo, numbers[a:b]


def _groups(documents: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Iterator[list]:
    """Documents by length, as many at a time as stay under ``_GROUP_TOKENS``; a longer one alone."""
    part, held = [], 0
    for d in sorted(documents, key=lambda d: d[1]):
        if part and held + d[1] > _GROUP_TOKENS:
            yield part
            part, held = [], 0
        part.append(d)
        held += d[1]
    if part:
        yield part


class _Group:
    """Training documents that are taken together, and the states their tokens are taught."""

    def __init__(self, model: Model, documents: list[tuple[int, int, np.ndarray, np.ndarray]], weights: tuple[float, float]):
        self.labels = np.array([d[0] for d in documents], float)
        self.each = np.where(self.labels > 0, weights[1], weights[0])
        self.bounds = np.r_[0, np.cumsum([d[1] for d in documents])].astype(np.int64)
        self.n = int(self.bounds[-1])
        self.tokens = np.concatenate([d[2].astype(np.int64) + lo for d, lo in zip(documents, self.bounds[:-1], strict=True)])
        self.numbers = np.concatenate([d[3].astype(np.int64) for d in documents])
        self.chain = Chain(self.bounds)
        self.weight = np.repeat(self.each, np.diff(self.bounds))
        self.taught = np.zeros(self.n, bool)
        self.taught[self.tokens[model.strong[self.numbers]]] = True
        self.taught &= np.repeat(self.labels > 0, np.diff(self.bounds))
        inner = np.ones(self.n, bool)
        inner[self.bounds[:-1][self.bounds[:-1] < self.bounds[1:]]] = False
        at = np.flatnonzero(inner)
        self.pairs = np.bincount(2 * self.taught[at - 1].astype(np.int64) + self.taught[at], self.weight[at], minlength=4).reshape(2, 2)

    def marginals(self, model: Model) -> np.ndarray:
        return self.chain.marginals(model.emission(self.tokens, self.numbers, self.n, self.bounds), model.transition)

    def gradient(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """(gradient of the token weights, expected transitions) of the log-likelihood."""
        p, expected, _ = self.chain.marginals(model.emission(self.tokens, self.numbers, self.n, self.bounds), model.transition, pairs=True, weight=self.weight)
        rest = (self.taught - p) * self.weight
        marked = np.zeros(self.n)
        marked[self.tokens] = 1
        left, right = model._neighbours(marked, self.bounds)
        return np.r_[np.bincount(self.numbers, rest[self.tokens], len(model.lexicon)), rest.sum(), rest @ left, rest @ right], expected


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None, sample: int = SAMPLE, least_docs: int = LEAST_DOCS, strong: float = STRONG, max_features: int = MAX_FEATURES) -> Model:
    """Trains on labelled documents for which ``keep`` (a condition on doc_id) holds."""
    keep = ~held_out(F.col("doc_id")) if keep is None else keep
    chosen = labelled_sample(labels, label, keep, sample)
    rows = training_rows(docs, chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(2).to_numpy()
            for chunk in chunks(batch.column(1)):
                doc = chunk.doc_of_word()
                own = y[chunk.first : chunk.first + chunk.n_docs]
                found = _distinct(doc, features(chunk))
                hashes, number = np.unique(found[1], return_inverse=True)
                bad = np.bincount(number, own[found[0]], len(hashes)).astype(np.int64)
                every = np.bincount(number, minlength=len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(bad), pa.array(every)], names=["feature", "bad", "n"])

    counts = rows.mapInArrow(count, "feature long, bad long, n long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    n_docs, n_bad = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    n_good = n_docs - n_bad
    weights = label_weights(labels, label, keep, sample)
    prior = (weights[1] * n_bad + 1) / (weights[0] * n_good + weights[1] * n_bad + 2)
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("n") - F.col("bad") + 0.5) / (n_good + 1.0))
    best = counts.filter(F.col("bad") >= least_docs).withColumn("odds", odds).filter(F.col("odds") >= strong / 2)
    kept = best.orderBy(F.desc("odds"), F.desc("bad"), "feature").limit(max_features).collect()
    model = Model(np.array([r.feature for r in kept], np.int64).view(np.uint64), np.array([r.odds >= strong for r in kept], bool), prior)
    if not kept:
        return model
    held = docs.sparkSession.sparkContext.broadcast(model)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                tokens, numbers = held.value.lookup(features(chunk))
                order = np.argsort(tokens, kind="stable")
                tokens, numbers = tokens[order], numbers[order]
                edges = np.searchsorted(tokens, chunk.bounds)
                part = batch.slice(chunk.first, chunk.n_docs)
                places = [(tokens[a:b] - lo).astype(np.int32).tobytes() for a, b, lo in zip(edges[:-1], edges[1:], chunk.bounds[:-1], strict=True)]
                which = [numbers[a:b].astype(np.int32).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(np.diff(chunk.bounds)), pa.array(places, pa.binary()), pa.array(which, pa.binary())], names=["doc_id", "y", "n", "places", "numbers"])

    seen = sorted({(r.doc_id, r.y, r.n, bytes(r.places), bytes(r.numbers)) for r in rows.mapInArrow(hits, "doc_id long, y int, n long, places binary, numbers binary").toLocalIterator()})
    model.fit([(y, n, np.frombuffer(places, np.int32), np.frombuffer(which, np.int32)) for _, y, n, places, which in seen], weights=weights)
    return model


def _distinct(doc: np.ndarray, found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) without repeats."""
    docs, hashes = np.concatenate([doc] * len(found)), np.concatenate(found)
    used = hashes != 0
    docs, hashes = docs[used], hashes[used]
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    first = np.ones(len(docs), bool)
    first[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    return docs[first], hashes[first]


def score(docs: DataFrame, model: Model, flag: float = 0.5) -> DataFrame:
    """(doc_id, score, spans) for each row of ``docs``.

    spans: byte offsets, in the UTF-8 text, of runs of tokens whose marginal is over ``flag``, with
    the largest marginal.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                scores, p = held.value.apply(chunk)
                spans: list[list[dict]] = [[] for _ in range(chunk.n_docs)]
                toxic = np.flatnonzero(p > flag)
                if len(toxic):
                    doc = np.searchsorted(chunk.bounds, toxic, "right") - 1
                    cuts = np.flatnonzero((np.diff(toxic) > 1) | (np.diff(doc) > 0)) + 1
                    for run_ in np.split(np.arange(len(toxic)), cuts):
                        a, b, d = toxic[run_[0]], toxic[run_[-1]], doc[run_[0]]
                        base = chunk.doc_bytes[d]
                        spans[d].append({"first": int(chunk.start[a] - base), "end": int(chunk.end[b] - base), "p": float(p[a : b + 1].max())})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.n_docs), pa.array(scores), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, spans array<struct<first: int, end: int, p: double>>")
