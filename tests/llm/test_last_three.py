"""Whitening, the divergence audit and byte-level BPE against brute force."""

import codecs
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import re
import tiktoken

from carrel.llm import bpe, divergence, queries, ranking, sql, whitening
from tests.compare import check

SF = "/root/testdata/sf0.001"
RANKS = bpe.read_ranks(queries.RANKS)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def integers(vector):
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in vector]


def plain_whitening(rows, n_components=16):
    """{(id, x): (n, deviation, coordinates without sign)}, shares."""
    good = [(i, integers(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in good}), object)
    n, sums = len(fit), fit.sum(axis=0)
    away = (fit * n - sums).astype(float) / n
    values, rows_ = np.linalg.eigh(away.T @ away / n)
    values, rows_ = values[::-1][:n_components], rows_[:, ::-1][:, :n_components]
    out = {}
    for i, x in good:
        far = np.array(x, object) * n - sums
        out[i, tuple(x)] = (n, int((far**2).sum()), np.abs(far.astype(float) / n @ rows_ / np.sqrt(values)))
    return out, values / np.trace(away.T @ away / n)


def agrees(got, rows, n_components=16):
    expected, shares = plain_whitening(rows, n_components)
    by_row = {}
    for r in got:
        by_row.setdefault((r.vec_id, r.deviation), []).append(r)
    assert {(i, d) for (i, _), (_, d, _) in expected.items()} == set(by_row)
    for (i, _), (n, deviation, near) in expected.items():
        own = sorted(by_row[i, deviation], key=lambda r: r.component)[: len(near)]
        assert [r.component for r in own] == list(range(1, len(near) + 1)) and {r.n for r in own} == {n}
        assert np.allclose([abs(r.whitened) for r in own], near, atol=1e-7)
        assert np.allclose([r.explained for r in own], shares[: len(own)], rtol=1e-9)
        assert all(0 <= r.identity_error < 1e-9 for r in own)


def test_whitening_of_a_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = queries.op11_whitening(spark, SF).collect()
    assert len(got) == 16 * len(rows)
    agrees(got, rows)


def test_whitening_edge_cases(spark):
    rng = np.random.default_rng(2)
    base = [[float(v) for v in row] for row in rng.normal(size=(30, 3))]
    rows = list(enumerate(base)) + [(100 + i, base[0]) for i in range(50)] + [(None, base[1])]
    odd = [(200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 2.0]), (204, [float("inf"), 0.0, 0.0]), (205, [1.0, 2.0])]
    kind = "vec_id long, embedding array<double>"
    table = spark.createDataFrame(rows + odd, kind).selectExpr("*", "1 AS x", "2 AS n").repartition(7)
    vectors = whitening.integers(table)
    agrees(whitening.whitened(vectors, whitening.fit(vectors)).collect(), rows, 3)
    flat = spark.createDataFrame([(i, [float(v[0]), 5.0, 2 * float(v[0])]) for i, v in rows], kind)
    got = whitening.whitened(whitening.integers(flat), whitening.fit(whitening.integers(flat))).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-4  # rounding leaves a little of a second direction
    for few in (table.limit(0), spark.createDataFrame([(1, base[0]), (2, base[0])], kind)):
        v = whitening.integers(few)
        assert whitening.whitened(v, whitening.fit(v)).count() == 0
    far = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], kind)
    v = whitening.integers(far)
    assert {(r.vec_id, r.deviation) for r in whitening.whitened(v, whitening.fit(v)).collect()} == {(1, None), (2, None), (3, 0)}


def test_moments_merge_in_any_parts(spark):
    rng = np.random.default_rng(5)
    rows = rng.integers(-500, 500, (200, 4)).astype(float)
    parts = [whitening.Moments(4) for _ in range(9)]
    for i, row in enumerate(rows):
        parts[i % 7].add(row)  # two stay empty
    out = whitening.Moments(4)
    for part in parts:
        out.merge(part)
    assert out.n == 200 and np.allclose(out.mean, rows.mean(axis=0)) and np.allclose(out.m2 / 200, np.cov(rows.T, bias=True))


@pytest.mark.parametrize("dims", [1, 2, 3, 17, 64])
def test_eigen_solve(dims):
    rng = np.random.default_rng(dims)
    for matrix in (np.cov(rng.normal(size=(dims, 4 * dims))).reshape(dims, dims), np.zeros((dims, dims)), np.ones((dims, dims)), np.diag(np.arange(dims) % 2.0)):
        values, rows = whitening.eigen(matrix)
        assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1], atol=1e-12)
        assert np.allclose(rows @ rows.T, np.eye(dims), atol=1e-12) and np.allclose(rows @ matrix @ rows.T, np.diag(values), atol=1e-12)


TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain_audit(rows):
    """rows: (text, lang, source)."""
    rows = [tuple(c or "" for c in r) for r in rows]
    n, docs = Counter(), Counter()
    for text, lang, source in rows:
        terms = [t.translate(LOWER) for t in TERM.findall(text)]
        n.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    groups = {(lang, source) for _, lang, source in rows}
    for lang in {g[0] for g in groups}:
        sources = sorted(s for x, s in groups if x == lang)
        terms = [t for (x, t), k in docs.items() if x == lang and k >= 10]
        share = lambda counts, v=len(terms): {t: 1 + 1_000_000_000 * (c + 2) // (sum(counts.values()) + 2 * v) for t, c in counts.items()}
        own = {s: {t: n[lang, s, t] for t in terms} for s in sources}
        p = {s: share(own[s]) for s in sources}
        q = share({t: sum(own[s][t] for s in sources) for t in terms})
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted(((-sum(f(p[s][t], p[o][t]) for t in terms), o) for o in sources if o != s), key=lambda x: (x[0], x[1].encode()))
            best = sorted(((-f(p[s][t], q[t]), t) for t in terms if own[s][t] and p[s][t] > q[t]), key=lambda x: (x[0], x[1].encode()))[:10]
            for part, found in (("pair", pairs), ("term", best)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def audited(docs):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in divergence.audit(docs).collect())


def test_audit_agrees_with_sql(spark):
    check(spark, "/root/testdata/sf0.01", queries.op12_divergence, sql.OP12)


def test_audit_edge_cases(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in "abcdeé𝄞Aß" for b in "xyzÄ漢Z"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 40, 400]))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", "𝄞", "z", None, ""])) for _ in range(300)]
    rows += [(None, "en", "a"), ("", "fr", "only"), (" 1 2 ", "fr", "two"), ("rare words of one text", "fr", "three"), ("Long " * 30_000, "en", "b"), ("x" * 50_000, "en", "c")]
    rows += [("tie" + c * k, "it", s) for k in (1, 3) for c in "qrstuvwxyz" for s in ("a", "b") for _ in range(12)]  # more than ten equal values
    rows += [("tie" + "p" * k, "it", "a") for k in range(1, 9) for _ in range(10)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").selectExpr("*", "1 AS doc_id", "2 AS n", "text AS term").repartition(5)
    got = audited(docs)
    assert got == plain_audit(rows)
    assert audited(docs.limit(0)) == []


def test_words_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(divergence.Chunk, "hashes", lambda self, lower: np.zeros(len(self.start), np.uint64))
    monkeypatch.setattr(divergence, "mix", lambda x: x * np.uint64(0))
    chunk = next(divergence.chunks(divergence.pa.array(["b a A", "c a", "a"]), 1 << 20, divergence._BETWEEN))
    group, terms, n, docs = divergence._counted(chunk, np.array([0, 1, 0]))
    assert sorted(zip(group.tolist(), terms.to_pylist(), n.tolist(), docs.tolist(), strict=True)) == [(0, b"a".decode(), 3, 2), (0, "b", 1, 1), (1, "a", 1, 1), (1, "c", 1, 1)]


def test_radix_select_as_sorting_does(spark):
    rng = random.Random(8)
    rows = [(g, rng.choice([0, 1, 2, 300, 70_000, 1 << 40, rng.randrange(1 << 33)]), "".join(rng.choice("ab漢é𝄞") for _ in range(rng.randrange(12)))) for g in "xyz" for _ in range({"x": 400, "y": 60, "z": 4}[g])]
    rows = list({(g, i): (g, v, i) for g, v, i in rows}.values())
    made = spark.createDataFrame(rows, "g string, v long, item string").repartition(6)
    for k in (1, 7, 50):
        got = sorted((r.g, r["rank"], r.v, r.item) for r in ranking.first_ranks(made, ["g"], "v", "item", k).collect())
        expected = []
        for g in "xyz":
            own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2].encode()))[:k]
            expected += [(g, i + 1, v, item) for i, (_, v, item) in enumerate(own)]
        assert got == expected
    assert ranking.first_ranks(made.limit(0), ["g"], "v", "item", 3).count() == 0


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_bpe_of_a_table_as_tiktoken_has_it(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_bpe(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_bpe_of_odd_texts():
    rng = random.Random(1)
    some = [*"abcdeinorst", "é", "ß", " ", "  ", "\n", "\t", "1", "ا", "漢", "🙂", "'s", "'", "-", "_", " ", " ", "\x1c", "\x85", "\x00", "<|endoftext|>", "é"]
    texts = ["", " ", "  a", "a  ", "x" * 3000, " " * 3000, "ab" * 4000, "a1" * 3000, " a" * 3000] + ["".join(rng.choice(some) for _ in range(rng.choice([1, 3, 9, 40, 300]))) for _ in range(3000)]
    small = bpe.Encoder(RANKS, public_tokenizers.PATTERN, pieces=5, states=50)  # both caches overflow
    large = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in texts:
        expected = packed(TIKTOKEN.encode_ordinary(text))
        assert large.encode(text) == expected, text
        if len(text) < 100:
            assert small.encode(text) == expected, text
            assert b"".join(b"".join(map(large._piece, found)) for found in large.blocks(text, 4)) == expected, text
        assert bpe._decoded(large.vocabulary.tokens, expected, 3) == text


def test_bpe_of_every_character():
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for c in [*range(0xD800), *range(0xE000, 0x20000, 3), *range(0x20000, 0x110000, 997)]:
        text = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}"
        assert encoder.encode(text) == packed(TIKTOKEN.encode_ordinary(text)), hex(c)


def test_every_token_is_what_merging_gives():
    words = bpe.Vocabulary(RANKS)
    machine = bpe.Transducer(words)
    for rank in range(0, len(words.tokens), 7):
        assert machine.encode(words.tokens[rank]) == packed([rank])
    rng = random.Random(6)
    for _ in range(500):  # bytes that are no text
        data = bytes(rng.randrange(256) for _ in range(rng.randrange(1, 30)))
        parts = [bytes([b]) for b in data]
        while len(parts) > 1:
            best, at = min((RANKS.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best == 1 << 40:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        assert machine.encode(data) == packed([RANKS[p] for p in parts])


def test_stream_decoding_in_any_portions():
    rng = random.Random(3)
    tokens = bpe.Vocabulary(RANKS).tokens
    for i in range(1500):
        ids = [rng.randrange(len(tokens)) for _ in range(20)] if i % 2 else TIKTOKEN.encode_ordinary("漢é🙂 字 ab ش" * 2)
        mine, python = bpe.StreamDecoder(tokens), codecs.getincrementaldecoder("utf-8")("replace")
        while ids:
            part, ids = ids[: (k := rng.choice([1, 1, 2, 5]))], ids[k:]
            assert mine.feed(part) == python.decode(b"".join(map(tokens.__getitem__, part)))
        assert mine.close() == python.decode(b"", True)


def test_bpe_edge_cases(spark):
    rows = [(None, "x"), (1, None), (1, None), (2, ""), (3, "long " * 200_000 + "y" * 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS decoded")
    encoded = bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, bytes(r.ids)) for r in encoded.collect()), key=str)
    assert got == sorted(((d, packed(TIKTOKEN.encode_ordinary(t or ""))) for d, t in rows), key=str)
    assert sorted(map(tuple, bpe.decode(encoded, queries.RANKS).collect()), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert bpe.encode(docs.limit(0), queries.RANKS, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(Exception, match="IndexError|list index"):
        bpe.decode(spark.createDataFrame([(1, b"\xff\xff\xff\x00")], "doc_id long, ids binary"), queries.RANKS).collect()
