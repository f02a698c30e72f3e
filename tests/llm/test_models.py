"""Toxicity and language model against brute force and held-out rows; all queries against their SQL."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from carrel.llm import gru, language_model, quality, queries, toxicity, words
from tests.compare import check

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    check(spark, LARGER, queries.queries()[name], queries.oracle_sql()[name])


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(5)
    bounds = np.array([0, 4, 4, 5, 12])
    emission, transition = rng.normal(size=12), rng.normal(size=(2, 2))
    p, pairs, log_z = toxicity.Chain(bounds).marginals(emission, transition, pairs=True)
    total, expected = 0.0, np.zeros((2, 2))
    for lo, hi in itertools.pairwise(bounds):
        if lo == hi:
            continue
        weight, one, both = 0.0, np.zeros(hi - lo), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=hi - lo):
            steps = list(itertools.pairwise(path))
            w = math.exp(sum(emission[lo + i] for i, s in enumerate(path) if s) + sum(transition[a][b] for a, b in steps))
            weight += w
            one += w * np.array(path)
            for a, b in steps:
                both[a, b] += w
        assert np.allclose(p[lo:hi], one / weight)
        expected += both / weight
        total += math.log(weight)
    assert np.allclose(pairs, expected) and math.isclose(log_z, total)


def test_toxicity_on_held_out_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    got = queries.op3_toxicity(spark, LARGER).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        data = docs[r.doc_id].encode()
        assert all(0 <= s.first < s.end <= len(data) and data[s.first : s.end].decode() for s in r.spans)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


@pytest.mark.parametrize("clean, bad", [("he told them that she was a friend of mine", "he told them that she was an idiot of mine"), ("fine words here", "such an idiot he is")])
def test_toxicity_edge_cases(spark, clean, bad):
    rows = [(i, clean if i % 2 else bad, "s") for i in range(60)]
    odd = [(100, None, "s"), (101, "", "s"), (102, "!!! ---", "s"), (103, "w " * 30_000 + "idiot!", "s"), (103, "w " * 30_000 + "idiot!", "s"), (None, "x", "s")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, spans string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)] + [(None, 1), (100, None)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 66 and by[101].score == by[100].score < 0.5 and by[0].score > 0.7 > by[1].score
    assert [(s.first, s.end) for s in by[103].spans] == [(60_000, 60_006)]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.5}


def test_scores_do_not_depend_on_the_sample(spark):
    clean, bad = "he told them that she was a friend of mine", "he told them that she was an idiot of mine"
    rows = [(i, "" if i % 40 == 9 else bad if i % 10 == 0 or i % 40 == 1 else clean) for i in range(1_200)]
    docs = spark.createDataFrame([*rows, (5_001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 10 == 0 else 0, 0 if i % 10 == 0 else 1) for i, _ in rows], "doc_id long, toxic int, quality int")
    share = {True: [], False: []}
    logit = lambda p: math.log(p / (1 - p))
    for sample in (10_000, 100):
        model = toxicity.fit(docs, labels, sample=sample)
        by = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
        share[True].append(logit(by[0]))  # a text that stands under both labels, 4 to 1
        share[False].append({r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels, sample=sample)).collect()}[5_001])
    assert abs(share[True][0] - share[True][1]) < 0.8 and abs(share[True][0] - math.log(4)) < 0.8, share
    assert abs(share[False][0] - share[False][1]) < 0.02 and share[False][0] > 0.85


def test_votes_are_those_of_all_cosines(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["one", "Two", "3", "four,", "FIVE", "six!", "|", "seven-eight"], rng.integers(3, 40), p=np.roll([0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05], i % 2))) for i in range(120)]
    texts[7], texts[8] = texts[5], texts[5]  # ties among equal cosines
    rows = [(i, t) for i, t in enumerate(texts)] + [(200, None), (201, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    train = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    counts = {i: quality.term_counts(next(words.chunks(pa.array([t]))))[0].astype(np.float64) for i, t in rows if t and t.strip()}
    idf = np.log((1 + len(train)) / (1 + sum((counts[i] > 0).astype(float) for i in train))) + 0.1

    def unit(x):
        return x / np.linalg.norm(x)

    space = np.stack([unit(np.sqrt(counts[i]) * idf) for i in train])
    _, _, v = np.linalg.svd(space, full_matrices=False)
    project = v[: quality.RANK].T
    vectors = np.stack([unit(x @ project) for x in space])
    y = np.array([i % 2 for i in train])
    for i, x in counts.items():
        cosine = vectors @ unit(unit(np.sqrt(x) * idf) @ project)
        ordered = np.sort(cosine)[::-1]
        if ordered[quality.NEIGHBOURS - 1] - ordered[quality.NEIGHBOURS] < 1e-4:
            continue  # the last neighbour could be either
        near = np.argsort(-cosine)[: quality.NEIGHBOURS]
        weight = np.maximum(cosine[near], 1e-6) ** quality.POWER
        assert abs(got[i] - (weight @ y[near]) / weight.sum()) < 2e-3, i
    assert got[5] == pytest.approx(got[7], abs=1e-5) and got[5] == pytest.approx(got[8], abs=1e-5) and got[200] == got[201] == pytest.approx(y.mean())


def test_a_sample_is_bounded_however_often_its_rows_repeat(spark):
    rows = [(i, f"text {i} {j % 3}") for i in range(6) for j in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    chosen = quality.labelled_sample(labels, "quality", quality.F.lit(True), 4)
    found = quality.training_rows(docs, chosen).collect()
    assert len(found) == 4 and sorted(r.y for r in found) == [0, 0, 1, 1]


def test_votes_count_by_label_shares():
    counts = np.random.default_rng(1).integers(0, 5, (20, quality.TERMS)).astype(np.float32)
    counts[:] = counts[0]
    model = quality.Model(counts, np.repeat([0, 1], 10), neighbours=20, weights=(0.2, 1.8))
    assert np.allclose(model.scores(counts[:1]), 0.9) and math.isclose(model.prior, 0.9, rel_tol=1e-6)


def plain_network(n, ids):
    """Step by step, one document, with the distribution over all classes and words summed."""
    p, h, total = n.p, np.zeros(n.hidden), 0.0
    before = n.n_head + n.n_rare
    for i in ids:
        a = p["x"][before] + p["bias"]
        u = h @ p["u"]
        k = n.hidden
        z, r = (1 / (1 + np.exp(-(a[s] + u[s]))) for s in (slice(0, k), slice(k, 2 * k)))
        h = (1 - z) * np.tanh(a[2 * k :] + r * u[2 * k :]) + z * h
        classes = np.exp(h @ p["class_w"] + p["class_b"])
        classes /= classes.sum()
        inner = np.exp(h @ p["word_w"] + p["word_b"])
        inner /= inner.sum(axis=1, keepdims=True)
        every = np.r_[(classes[: n.n_classes, None] * inner).ravel()[: n.n_head], classes[n.n_classes :]]
        assert abs(every.sum() - 1) < 1e-5
        total += math.log(every[i])
        before = i
    return total


def test_network_scores_and_gradients():
    rng = np.random.default_rng(2)
    n = gru.Network(rng.integers(1, 50, 40), rng.uniform(1, 9, 3), hidden=5, width=8)
    n.load(n.flat() + rng.normal(0, 0.3, n.flat().size).astype(np.float32) * (n.flat() > -1e8))
    docs = [rng.integers(0, 43, k) for k in (7, 0, 1, 23)]
    bounds = np.r_[0, np.cumsum([len(d) for d in docs])]
    got = n.log_likelihood(np.concatenate(docs), bounds)
    assert np.allclose(got, [plain_network(n, d) for d in docs], atol=1e-3)
    for k in n.p:
        n.p[k] = n.p[k].astype(np.float64)
    ids, before = rng.integers(0, 43, (6, 4)), rng.integers(0, 44, (6, 4))
    _, g = n._window(before, ids, np.zeros((4, 5)))

    def loss():
        h, total, start = np.zeros((4, 5)), 0.0, n.n_head + n.n_rare
        for row, own in zip(before, ids, strict=True):
            h = n._step(n.p["x"][row] + n.p["bias"], np.where((row == start)[:, None], 0, h))[0]
            total -= n._log_p(h, own).sum()
        return total / ids.size * gru.STEPS

    for k in n.p:
        flat = n.p[k].reshape(-1)
        for at in rng.choice(flat.size, min(8, flat.size), replace=False):
            if flat[at] < -1e8:
                continue
            was = flat[at]
            flat[at] = was + 1e-5
            up = loss()
            flat[at] = was - 1e-5
            down = loss()
            flat[at] = was
            assert abs((up - down) / 2e-5 - g[k].reshape(-1)[at]) < 1e-3, k


def test_training_lowers_the_loss():
    rng = np.random.default_rng(4)
    docs = [np.tile(rng.permutation(5), 40) for _ in range(60)]
    n = gru.Network(np.full(5, 2400), np.full(2, 0.5))
    ids, bounds = np.concatenate(docs), np.arange(0, 12_001, 200)
    before = n.log_likelihood(ids, bounds).sum()
    for _ in range(3):
        assert n.train(docs) > 11_000
    assert n.log_likelihood(ids, bounds).sum() > 0.7 * before


def test_training_takes_every_token():
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 5, k) for k in (12_000, 1, 130)]
    n, seen = gru.Network(np.full(5, 2400), np.full(2, 0.5)), []
    window = n._window
    n._window = lambda before, ids, h: (seen.append(ids.size), window(before, ids, h))[1]
    assert n.train(docs) == sum(seen) == 12_131 and 12_131 % 5  # five streams


def test_every_training_document_is_in_one_round(spark, monkeypatch, tmp_path):
    train = language_model._train

    def noted(rows, network):
        for key in rows.column("key").to_pylist():
            with open(f"{tmp_path}/{key}", "a") as f:
                f.write("x")
        return train(rows, network)

    monkeypatch.setattr(language_model, "_train", noted)
    docs = spark.createDataFrame([(i, f"d{i}") for i in range(200)], "doc_id long, text string")
    language_model.fit(docs, group_tokens=20)
    keys = {r.doc_id: r.key for r in docs.selectExpr("doc_id", "xxhash64(doc_id, text) AS key").collect()}
    expected = {str(k) for i, k in keys.items() if zlib.crc32(str(i).encode()) % 5 != 1}
    assert {p.name for p in tmp_path.iterdir()} == expected and {p.read_text() for p in tmp_path.iterdir()} == {"x"}


def test_weights_are_averaged_in_bundles(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BUNDLE", 3)
    rng = np.random.default_rng(8)
    weights, tokens = rng.normal(size=(29, 2, 5)).astype(np.float32), rng.integers(1, 90, 29)
    rows = [(p, g, int(tokens[g]), bytearray(weights[g, p].tobytes())) for g in range(29) if g != 4 for p in (0, 1)]  # a group without documents
    got = language_model.averaged(spark.createDataFrame(rows, language_model._WEIGHTS), 29).collect()
    assert sorted((r.part, r.group, r.tokens) for r in got) == [(p, 0, tokens.sum() - tokens[4]) for p in (0, 1)]
    tokens[4] = 0
    for r in got:
        assert np.allclose(np.frombuffer(r.weights, np.float32), np.average(weights[:, r.part], axis=0, weights=tokens), atol=1e-6)


def test_rounds_and_groups_grow_with_the_tokens():
    size = language_model.GROUP_TOKENS
    assert [language_model.dealt(n * size) for n in (0, 1, 100, 1000, 10**6)] == [(4, 1), (4, 1), (4, 25), (10, 100), (16, 62500)]


def test_logits_that_no_bound_levels():
    n = gru.Network(np.full(20, 9), np.full(2, 4.0), hidden=3, width=8)
    n.p["class_w"][:, 1], n.p["word_w"][:, :, 2] = 90, -70
    h, ids = np.tanh(np.random.default_rng(3).normal(size=(50, 3))).astype(np.float32), np.arange(50) % 22
    got = n._log_p(h, ids)
    for i, own in enumerate(ids.tolist()):
        x = (h[i] @ n.p["class_w"] + n.p["class_b"]).astype(float)
        want = x[own // 8 if own < 20 else own - 20 + n.n_classes] - np.logaddexp.reduce(x)
        if own < 20:
            y = (h[i] @ n.p["word_w"][own // 8] + n.p["word_b"][own // 8]).astype(float)
            want += y[own % 8] - np.logaddexp.reduce(y)
        assert math.isclose(got[i], want, rel_tol=1e-4, abs_tol=1e-3)


def test_scores_do_not_depend_on_the_cluster(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("3", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            rows = docs.repartition(int(n), "lang")
            found.append({r.doc_id: r.score for r in language_model.score(rows, *language_model.fit(rows, group_tokens=4000)).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0].keys() == found[1].keys()
    assert all(math.isclose(found[0][d], found[1][d], rel_tol=1e-6) for d in found[0])


def test_a_head_where_all_words_are_equally_frequent(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(40)], "doc_id long, text string")
    model, rest = language_model.fit(docs, known=100, head=50)
    assert model.vocabulary.n_head == 50 and 50 <= len(model.vocabulary.counts) <= 150
    got = language_model.score(docs, model, rest).collect()
    assert all(r.n_known == (1 if zlib.crc32(str(r.doc_id).encode()) % 5 == 1 else 31) for r in got)


def test_language_model_counts_and_base_scores(spark, monkeypatch):
    monkeypatch.setattr(language_model, "KNOWN", 300)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_model.score(docs, *language_model.fit(docs, known=300, head=100)).collect()
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    counts = Counter(w for d, ws in texts.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    better = 0
    for r in got:
        own = texts[r.doc_id]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
        better += r.score > r.base_score
    assert len(got) == len(texts) and better > 0.9 * len(got)


def test_language_model_on_held_out_documents(spark):
    got = [r for r in queries.op6_language_model(spark, LARGER).collect() if r.held_out]
    assert got and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 1 for r in got)
    assert sum(r.score > r.base_score for r in got) > 0.9 * len(got)


def test_language_model_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "A b"), (3, "A b"), (None, "b c"), (4, "q " * 60_000), (6, "unheard words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS token")
    got = language_model.score(docs, *language_model.fit(docs)).collect()
    assert len(got) == 7 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2)} == {1}
    none = docs.limit(0)
    assert language_model.score(none, *language_model.fit(none)).count() == 0
    fitted = language_model.fit(none)
    assert all(math.isfinite(r.score) and r.n_known == 0 and r.train_tokens == 0 for r in language_model.score(docs, *fitted).collect())


def test_words_are_those_of_bytes_split():
    texts = ["", None, " a", "a\tb\x0bc\r\n", "Ä b c\x1cd", "x" * 100, "A a"]
    found = []
    for size in (1, 8, 1 << 20):
        out = []
        for chunk in words.chunks(pa.array(texts), size):
            data = chunk.data.tobytes()
            hashed = chunk.hashes(lower=True)
            for i in range(chunk.n_docs):
                at = range(chunk.bounds[i], chunk.bounds[i + 1])
                assert [data[chunk.start[j] : chunk.end[j]] for j in at] == (texts[chunk.first + i] or "").encode().split()
                out.append([int(hashed[j]) for j in at])
        found.append(out)
    assert found[0] == found[1] == found[2] and found[0][6][0] == found[0][6][1]
    assert [len(x) for x in words.chunks(pa.array([], pa.string()))] == []
