"""Divergence audit: how the words of each source differ from those of the other sources of its language.

Terms are counted in Arrow batches, a row for each term and (lang, source) of a piece of text, and
added up by partial aggregates. Each language keeps the terms of at least ``LEAST_DOCS`` documents.
Smoothed shares p and q of a term differ by floor((p - q)**2 / (p + q)).

Pairs of sources are compared sparsely. A term that a source never has gets the same p for all such
terms, its baseline, so the sum over all kept terms is that of two baselines for every term, plus
what the terms of either source change of it alone (from the numbers of terms by p, a short list for
each source), plus a correction for terms that both have. Only these terms are brought together,
by (lang, term) in buckets of bounded size, and added up where they meet, so a row leaves a task for a
pair of sources, not for a pair and term. The highest terms of a source are found by radix select
(``ranking``).

Cases: null text, lang and source count as ''; equal rows count each; a group without terms has its pairs,
and of no kept terms these have the value 0; a language of one source has no pairs; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carrel.llm.ranking import first_ranks
from carrel.llm.words import LOWER, Chunk, chunks, mix, same_bytes
from carrel.sources.staging import stage

LEAST_DOCS = 10
TOP = 10
UNIT = 1_000_000_000
BUCKET_ROWS = 1 << 17  #: of (source, term) rows, that a task compares at a time, about
_CHUNK_BYTES = 1 << 22
_OUT_ROWS = 1 << 16
#: bytes that belong to no term: all of ASCII but its letters
_BETWEEN = np.r_[np.ones(128, bool), np.zeros(128, bool)]
_BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_COUNTED = "lang string, source string, term string, n long, n_docs long"


def _texts_of(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The byte ranges as strings."""
    edges = np.r_[0, np.cumsum(size)]
    at = np.arange(edges[-1]) + np.repeat(start - edges[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())


def _counted(chunk: Chunk, group: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """(group, term, n, n_docs) of each group and term of a chunk; group: a number for each document."""
    doc = chunk.doc_of_word()
    own = group[doc]
    data = LOWER[chunk.data]
    size = chunk.end - chunk.start
    with np.errstate(over="ignore"):
        key = mix(chunk.hashes(lower=True) + own.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")  # documents stay in order
    ranked = key[order]
    head = np.r_[True, ranked[1:] != ranked[:-1]] if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(head)
    like = order[np.repeat(first, np.diff(np.r_[first, len(order)]))]  # the first word of equal key
    same = (size[order] == size[like]) & (own[order] == own[like])
    at = np.flatnonzero(same)
    same[at] = same_bytes(data, chunk.start[order[at]], chunk.start[order[at]] + size[order[at]], data, chunk.start[like[at]])
    if not same.all():  # two words of one hash: told apart by their bytes
        words = data.tobytes()
        named = [words[a : a + s] for a, s in zip(chunk.start.tolist(), size.tolist(), strict=True)]
        order = np.array(sorted(range(len(named)), key=lambda i: (own[i], named[i], doc[i])), np.int64)
        head = np.array([i == 0 or (own[order[i]], named[order[i]]) != (own[order[i - 1]], named[order[i - 1]]) for i in range(len(order))])
        first = np.flatnonzero(head)
    new = head.copy()
    new[1:] |= doc[order][1:] != doc[order][:-1]
    n = np.diff(np.r_[first, len(order)])
    n_docs = np.add.reduceat(new.astype(np.int64), first) if len(first) else n
    rep = order[first]
    return own[rep], _texts_of(data, chunk.start[rep], size[rep]), n, n_docs


def counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, n_docs): occurrences of each term and the documents that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, sources = (batch.column(i).dictionary_encode() for i in (0, 1))
            n_sources = max(1, len(sources.dictionary))
            group = langs.indices.to_numpy().astype(np.int64) * n_sources + sources.indices.to_numpy()
            for chunk in chunks(batch.column(2), _CHUNK_BYTES, _BETWEEN):
                own, terms, n, n_docs = _counted(chunk, group[chunk.first : chunk.first + chunk.n_docs])
                for lo in range(0, len(own), _OUT_ROWS):
                    part = slice(lo, lo + _OUT_ROWS)
                    lang, source = langs.dictionary.take(pa.array(own[part] // n_sources)), sources.dictionary.take(pa.array(own[part] % n_sources))
                    yield pa.RecordBatch.from_arrays([lang, source, terms[part], pa.array(n[part]), pa.array(n_docs[part])], names=["lang", "source", "term", "n", "n_docs"])

    plain = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = plain.mapInArrow(run, _COUNTED)
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def _share(n: str, total: str, kept: str) -> Column:
    return F.expr(f"1 + CAST({UNIT} AS DECIMAL(10, 0)) * CAST({n} + 2 AS DECIMAL(20, 0)) div ({total} + 2 * {kept})")


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / (p + q)); shares are below 2**30, so their squares fit a long."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared(kept: DataFrame, buckets: int) -> DataFrame:
    """(lang, a, b, value): what the terms that a and b both have add to the sum of what each has alone, a < b."""

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        sources = sorted(set(table.column("source").to_pylist()), key=str.encode)
        number = {s: i for i, s in enumerate(sources)}
        source = np.array([number[s] for s in table.column("source").to_pylist()], np.int64)
        term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        order = np.lexsort((source, term))
        source, term = source[order], term[order]
        p, base = (table.column(c).to_numpy()[order] for c in ("p", "base"))
        pairs, values = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        lag = 1
        while True:
            x = np.flatnonzero(term[lag:] == term[:-lag]) if lag < len(term) else np.zeros(0, np.int64)
            last = not len(x)
            if not last:
                y = x + lag
                value = _differ(p[x], p[y]) - _differ(p[x], base[y]) - _differ(base[x], p[y]) + _differ(base[x], base[y])
                found.append((source[x] * len(sources) + source[y], value))
                held += len(x)
            if last or held > BUCKET_ROWS:
                every = np.concatenate([pairs, *(f[0] for f in found)])
                pairs, at = np.unique(every, return_inverse=True)
                summed = np.zeros(len(pairs), np.int64)
                np.add.at(summed, at, np.concatenate([values, *(f[1] for f in found)]))
                values, found, held = summed, [], 0
            if last:
                break
            lag += 1
        names = pa.array(sources, pa.string())
        return pa.table({"lang": pa.array([key[0].as_py()] * len(pairs), pa.string()), "a": names.take(pa.array(pairs // len(sources))), "b": names.take(pa.array(pairs % len(sources))), "value": values})

    dealt = kept.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    made = dealt.select("lang", "bucket", "source", "term", "p", "base").groupBy("lang", "bucket").applyInArrow(compare, "lang string, a string, b string, value long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("shared"))


def _alone(own: str, p0: str, q0: str) -> Column:
    """What the terms of one source change of the sum, against the other's baseline."""
    return F.aggregate(F.coalesce(own, F.array().cast("array<struct<p:bigint,n:bigint>>")), F.lit(0).cast("long"), lambda s, x: s + x["n"] * (_apart(x["p"], F.col(q0)) - _apart(F.col(p0), F.col(q0))))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): the pairs and the highest terms of each (lang, source)."""
    made = stage(counts(docs), "audit-counts")
    groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    terms = made.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= least_docs)
    kept = stage(made.select("lang", "source", "term", "n").join(terms.select("lang", "term", "in_lang"), ["lang", "term"]), "audit-kept")
    langs = stage(kept.groupBy("lang", "term").agg(F.max("in_lang").alias("n")).groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total")), "audit-langs")
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    stats = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
    base = F.when(F.col("kept") > 0, _share("0", "total", "kept")).otherwise(0).cast("long")
    stats = stage(stats.withColumn("base", base), "audit-sources")
    rated = kept.join(stats, ["lang", "source"])
    rated = stage(rated.select("lang", "source", "term", "base", _share("n", "total", "kept").alias("p"), _share("in_lang", "lang_total", "kept").alias("q")), "audit-rated")

    over = rated.filter("p > q").select("lang", "source", F.col("term").alias("item"), _apart(F.col("p"), F.col("q")).alias("value"))
    best = first_ranks(over, ["lang", "source"], "value", "item", top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")

    shared = _shared(rated, rated.count() // BUCKET_ROWS + 1)
    lists = rated.groupBy("lang", "source", "p").agg(F.count("*").alias("n")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("own"))
    sides = stats.select("lang", "source", "kept", "base").join(lists, ["lang", "source"], "left")
    left = sides.select("lang", "kept", F.col("source").alias("a"), F.col("base").alias("p0"), F.col("own").alias("own_a"))
    right = sides.select("lang", F.col("source").alias("b"), F.col("base").alias("q0"), F.col("own").alias("own_b"))
    both = left.join(right, "lang").filter(F.encode("a", "UTF-8") < F.encode("b", "UTF-8")).join(shared, ["lang", "a", "b"], "left")
    value = F.col("kept") * _apart(F.col("p0"), F.col("q0")) + _alone("own_a", "p0", "q0") + _alone("own_b", "q0", "p0") + F.coalesce("shared", F.lit(0))
    pairs = stage(both.select("lang", "a", "b", F.when(F.col("kept") > 0, value).otherwise(0).cast("long").alias("value")), "audit-pairs")
    ways = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))
    rank = F.row_number().over(W.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = ways.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    return ranked.unionByName(best)
