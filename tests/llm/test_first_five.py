"""Token output, SimHash, decontamination and mixing against brute force."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from carrel.llm import dac, decontaminate, mixing, quality, queries, simhash, tokenize
from carrel.llm.components import connected
from carrel.sources.staging import BATCH_BYTES, small_batches, stage

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, sf=SF):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """fps: (doc_id, fingerprint) rows; component by doc_id."""
    found = {d: d for d, _ in fps}

    def root(x):
        while found[x] != x:
            x = found[x]
        return x

    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= 2:
                p, q = sorted((root(a), root(b)))
                found[q] = p
    return {d: root(d) for d, _ in fps}


def test_simhash_is_the_brute_force(spark):
    rows = documents(spark)
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    expected = plain_components(fps)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op1_simhash(spark, SF).collect()}
    assert got == {d: (f"{x:016x}", expected[d]) for d, x in fps}


def test_simhash_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "one", 0), (5, "ONE", 0), (5, "ONE", 0), (6, long, 0), (7, long + " x", 0), (None, "one", 0)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.component_id for r in got}
    assert by == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, None: 4}
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ball_links_every_pair_at_the_radius(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 20)]
    fps = set(base)
    for x in base[:10]:
        for _ in range(5):
            a, b = rng.choice(64, 2, replace=False)
            fps.add(int(np.int64(np.uint64(x % 2**64) ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)))))
    links = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    got = {r.node: r.component for r in connected(links).collect()}
    ids = sorted(fps)
    expected = plain_components([(x, x % 2**64) for x in ids])
    assert {x: got.get(x, x) for x in ids} == expected


def test_components_of_chains_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


@pytest.mark.parametrize("limit", [20_000, 3])
def test_decontamination_is_exact_containment(spark, limit):
    rows = documents(spark)
    items = [r.asDict() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    some = items[0]["text"].split()
    rows += [{"doc_id": 9000, "text": "x " + " ".join(some[:-3]) + " tail"}, {"doc_id": 9001, "text": " ".join(some[: len(some) // 2])}, {"doc_id": 9002, "text": None}, {"doc_id": 9003, "text": "Two Words stand"}]
    items += [{"item_id": 500, "text": "two words"}, {"item_id": 501, "text": ""}, {"item_id": 502, "text": None}]
    expected = set()
    for d in rows:
        for i in items:
            own = shingles(i["text"])
            k = len(next(iter(own))) if own else 0
            if own and len(own & shingles(d["text"], k) if k == 5 else own & {g for g in all_grams(d["text"], k)}) >= decontaminate.needed(len(own), 0.8):
                expected.add((d["doc_id"], i["item_id"]))
    docs = spark.createDataFrame([(d["doc_id"], d["text"]) for d in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(i["item_id"], i["text"]) for i in items], "item_id long, text string")
    got = decontaminate.leaks(docs, bench, broadcast_items=limit).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
    assert (9000, 0) in expected and (9001, 0) not in expected and (9003, 500) in expected
    assert {r.doc_id for r in decontaminate.clean(docs, bench, broadcast_items=limit).collect()} == {d["doc_id"] for d in rows} - {d for d, _ in expected}


@pytest.mark.parametrize("limit", [20_000, 0])
def test_clean_judges_rows_by_themselves(spark, limit):
    leaked, clean = "a text that holds the item of the test set as it is", "a text that holds nothing of the kind at all here"
    rows = [(None, leaked, 1, 2), (None, clean, 1, 2), (None, clean, 1, 2), (5, leaked, 1, 2), (5, clean, 1, 2), (5, clean, 9, 2), (6, None, 1, 2), (7, "", 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _leaked long, key long")
    bench = spark.createDataFrame([(1, "holds the item of the test set"), (2, None), (3, "")], "item_id long, text string")
    got = decontaminate.clean(docs, bench, broadcast_items=limit)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in rows if r[1] != leaked), key=str)
    found = decontaminate.leaks(docs, bench, broadcast_items=limit).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == [(5, 1), (None, 1)]
    for a, b in ((docs.limit(0), bench), (docs, bench.limit(0)), (docs.limit(0), bench.limit(0))):
        assert decontaminate.leaks(a, b, broadcast_items=limit).count() == 0
        assert decontaminate.clean(a, b, broadcast_items=limit).count() == a.count()


def all_grams(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def test_mix_meets_its_targets(spark):
    rows = queries.op10_mix(spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r for r in documents(spark, "/root/testdata/sf0.01")}
    by = {}
    for r in rows:
        assert r["size"] == len((docs[r.doc_id]["text"] or "").encode().split())
        assert 0 <= r.taken <= 2 * r["size"]
        by.setdefault(docs[r.doc_id]["source"], []).append(r)
    total = sum(r["size"] for r in rows)
    names = sorted(by, key=lambda s: s.encode())
    caps = {s: 2 * sum(r["size"] for r in by[s]) for s in names}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held = set()
    while True:
        level = (1.5 * total - sum(caps[s] for s in held)) / sum(weights[s] for s in names if s not in held)
        over = {s for s in names if s not in held and caps[s] < level * weights[s]}
        if not over:
            break
        held |= over
    for s in names:
        target = caps[s] if s in held else level * weights[s]
        assert all(r.target == pytest.approx(target) for r in by[s])
        assert abs(sum(r.taken for r in by[s]) - target) < 1
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op10_mix(spark, "/root/testdata/sf0.01").collect()))


def test_mix_edge_cases(spark):
    rows = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "x y z", "en", None, 5), (3, "x y z", "en", None, 5), (4, "w " * 1000, "en", "b", 2000), (None, "p q", "en", "c", 3)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS taken")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r["size"] for r in got)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sum(len(r.text.split()) for r in out.collect()) == sum(r.taken for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    assert mixing.mixed(spark.createDataFrame([(1, "", "en", "a", 0)], DOCS)).count() == 0


ODD = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "\n", "\na", "a\n", "a\t\n\tb", "don't I'll 12ab !? x", "ä ö   b", "<|endoftext|> x<|endoftext|>", "<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>\nb <|endoftext|>", "<|endoftext", "|>", "<|endoftext|> a", "a <|endoftext|>", "日本語 テキスト\n二行", "x" * 5000, "a\r\nb c", "\x1f a", "a \u2003b c", "é́ ​", "a\u00a0 \u00a0b", "a b\u3000", "\u3000a b"]


def test_pieces_encode_as_whole_texts(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.TOKENIZER)
    texts = ODD + [r["text"] for r in documents(spark)] + ODD
    got = list(tokenize.Encoder(queries.TOKENIZER).encode(pa.array(texts)))
    for text, ids in zip(texts, got, strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]


def test_tokens_round_trip(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.TOKENIZER)
    got = {r.doc_id: r for r in queries.op4_tokens(spark, SF).collect()}
    start = 0
    for r in sorted(documents(spark), key=lambda r: r["doc_id"]):
        ids = plain.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        one = got.pop(r["doc_id"])
        assert (one.start, one.n_tokens, one.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_tokens_edge_cases(spark):
    rows = [(3, None), (1, ""), (2, "a b"), (2, "a b"), (None, "c")]
    files = tokenize.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), queries.TOKENIZER, file_tokens=2)
    got = sorted(tokenize.read_tokens(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 1, 2, 2, 3] and [r.n_tokens for r in got] == [2, 1, 3, 3, 1]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert tokenize.read_tokens(tokenize.write_tokens(empty, queries.TOKENIZER)).count() == 0


def test_random_access_through_range_reads(spark):
    rows = [(i, r["text"]) for i, r in enumerate(documents(spark)[:20])]
    files = tokenize.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), queries.TOKENIZER, file_tokens=2000)
    encoder = tokenize.Encoder(queries.TOKENIZER)
    for row in files.collect():
        reader = tokenize.opened(row.path)
        for i, doc_id in enumerate(reader.doc_id.tolist()):
            ids = [*encoder.whole(rows[doc_id][1]).tolist(), tokenize.END]
            lo = int(reader.first[i])
            assert reader.document(i).tolist() == ids
            assert [reader.token(lo + j) for j in range(0, len(ids), 11)] == ids[::11]


def test_words_of_equal_hashes_are_told_apart(monkeypatch):
    from carrel.llm.words import Chunk

    monkeypatch.setattr(Chunk, "hashes", lambda self, lower, start=None, end=None: (self.end - self.start).astype(np.uint64))
    encoder = tokenize.Encoder(queries.TOKENIZER)
    texts = ["ab cd ab", "cd ab", "xyz", "ab abc"]
    for text, ids in zip(texts * 2, list(encoder.encode(pa.array(texts))) + list(encoder.encode(pa.array(texts))), strict=True):
        assert ids.tolist() == encoder.whole(text).tolist()


def test_memory_of_token_files_is_bounded(spark, monkeypatch):
    """The library, numpy and the workers get a bounded part of many new words, whatever the size of a batch."""
    given, whole = [], tokenize.Encoder.whole
    encoder = tokenize.Encoder(queries.TOKENIZER)
    monkeypatch.setattr(tokenize.Encoder, "whole", lambda self, text: given.append(len(text)) or whole(self, text))
    texts = [" ".join(f"{chr(97 + i % 26)}{i * 7919 + j}" for j in range(400)) for i in range(400)]
    arrow = pa.array(texts)
    tracemalloc.start()
    try:
        got = [zlib.crc32(ids.tobytes()) for ids in encoder.encode(arrow)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, texts)) > 1 << 20 and max(given) < 1 << 17
    assert peak < 110e6
    assert got[::100] == [zlib.crc32(whole(encoder, text).tobytes()) for text in texts[::100]]

    tracemalloc.start()
    try:
        file = dac.Writer()
        for i in range(100_000):
            file.add(i, np.array([2], np.uint32))
        held = tracemalloc.get_traced_memory()[0]
        reader = dac.Reader(dac.within(file.data()))
    finally:
        tracemalloc.stop()
    assert held < 40 * 100_000 and len(reader) == 100_000 and reader.document(99_999).tolist() == [2] and reader.doc_id[-1] == 99_999

    key, rows = "spark.sql.execution.arrow.maxBytesPerBatch", spark.range(200, numPartitions=1).selectExpr("id doc_id", "repeat('ab ', 30000) || 'c' text")
    before, seen = spark.conf.get(key), []
    monkeypatch.setattr(tokenize, "stage", lambda df, name: seen.append(spark.conf.get(key)) or stage(df, name))
    assert tokenize.write_tokens(rows, queries.TOKENIZER).selectExpr("sum(n_docs)").first()[0] == 200
    with small_batches(spark):
        sizes = [r.n for r in rows.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
    assert [int(x.rstrip("b")) for x in seen] == [BATCH_BYTES] and len(sizes) > 2 and max(sizes) < 2 * BATCH_BYTES
    assert spark.conf.get(key) == before


def test_codes_are_directly_addressable():
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, top, n).astype(np.uint32) for top, n in ((200, 50), (60_000, 3000), (2**32, 700), (5, 0))]
    data = dac.encode([4, 5, None, 9], docs)
    taken = []

    def read(offset, n):
        taken.append(n)
        return data[offset : offset + n]

    reader = dac.Reader(read)
    opening, before = sum(taken), len(taken)
    ids = np.concatenate(docs)
    assert reader.token(3000) == ids[3000] and opening + sum(taken[before:]) < 1000  # no block is decoded for one token
    assert len(reader) == len(ids) and reader.known.tolist() == [1, 1, 0, 1]
    assert [reader.token(i) for i in range(0, len(ids), 7)] == ids[::7].tolist()
    for i, own in enumerate(docs):
        assert reader.document(i).tolist() == own.tolist()


def test_quality_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op8_quality(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "b"), (None, "x y", "c"), (4, "q " * 70_000, "d"), (4, "q " * 70_000, "d")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(4, 1), (4, 0), (7, 1), (2, None)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    assert quality.keep_good(docs, labels).columns == docs.columns


@pytest.mark.parametrize("radius", [1, 2])
def test_links_connect_what_all_pairs_connect(spark, radius):
    rng = np.random.default_rng(radius)
    values = {0b1100, 0b1101, 0b0100, 0b1001, *(int(v) for v in rng.integers(0, 1 << 9, 60))}
    values |= {v ^ (1 << 63) for v in list(values)[:20]}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius).collect()
    assert all((r.a ^ r.b).bit_count() <= radius if (r.a < 0) == (r.b < 0) else ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= radius for r in found)

    def components(pairs):
        group = {v: v for v in signed}
        for a, b in list(pairs) * 12:
            group[a] = group[b] = min(group[a], group[b])
        for _ in range(len(signed)):
            for a, b in pairs:
                group[a] = group[b] = min(group[a], group[b])
        return group

    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    assert components([(r.a, r.b) for r in found]) == components(pairs)
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)
