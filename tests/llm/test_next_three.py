"""WARC, quality rules and substring dedup against brute force."""

import gzip
import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from carrel.llm import queries, rules, substring, warc, words

SF = "/root/testdata/sf0.001"
WS = re.compile("[^\\x20\\x09-\\x0D]+")


def table(spark, name):
    return [r.asDict() for r in spark.read.parquet(f"{SF}/{name}.parquet").collect()]


def plain_warc(rows):
    """rows: (page_id, html)."""
    first = {}
    for page_id, html in rows:
        if page_id is not None and len((html or "").encode()) >= 100:
            first[html] = min(page_id, first.get(html, page_id))
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        target = first.get(html) if len(data) >= 100 else None
        again = target is not None and target != page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", target if again else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    got = queries.op2_warc(spark, SF).collect()
    assert sorted(map(tuple, got), key=str) == plain_warc([(r["page_id"], r["html"]) for r in table(spark, "pages")])


def test_warc_edge_cases_and_selection(spark):
    big = "ü" * 60
    rows = [(1, "http://a", None), (2, None, ""), (3, "http://a b\n", "x" * 99), (4, "http://b", "x" * 99), (5, "http://c", big), (6, "http://d", big), (6, "http://d", big), (None, "http://e", big), (8, "http://f", "y\r\n\r\nz" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS archive")
    index = warc.write(pages, archive_bytes=5000)
    got = warc.read(index, read_bytes=100, gap=0).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == plain_warc([(a, c) for a, _, c in rows])
    ids = []
    for path in {r.archive for r in index.collect()}:
        ids += re.findall(rb"WARC-Record-ID: (\S+)", gzip.decompress(warc.read_range(path, 0, 1 << 30)))
    assert len(ids) == len(set(ids)) > len(rows)  # rows of one page, and the archives' own records, too
    some = warc.read(index.filter("page_id in (1, 8)")).collect()
    assert {(r.page_id, bytes(r.payload)) for r in some} == {(1, b""), (8, ("y\r\n\r\nz" * 9000).encode())}
    assert warc.read(warc.write(pages.limit(0))).count() == 0


def plain_rules(text):
    text = text or ""
    words = WS.findall(text)
    seen, lines = Counter(), 0
    for line in text.split("\n"):
        if WS.search(line):
            lines += seen[line] > 0
            seen[line] += 1
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(grams)
    covered = set()
    for i, g in enumerate(grams):
        if often[g] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), lines, len(covered)


def test_rules_measure_as_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents")}
    for r in queries.op5_rules(spark, SF).collect():
        n, chars, symbols, lines, repeats = plain_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeats)
        assert r.base_failed == (n < 20 or 100 * repeats > 30 * n)
        assert not (r.base_failed and r.kept)


def test_rules_edge_cases(spark):
    texts = [None, "", " \n ", "a b c d e f g h " * 3, "x " * 25_000, "l\nl\n\n \n \nl", "é é \x1c 𝄞", "a b c d e f g h a b c d e f g h i"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS n_words", "2 AS failed")
    for r in rules.ledger(docs).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_rules(texts[r.doc_id])
    assert rules.ledger(docs.limit(0)).count() == 0


def test_policies_and_ablation_are_bitwise(spark):
    book = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    rows = book.collect()
    for r in rules.ablation(book, "strict-1").collect():
        bit = rules.mask([r.rule])
        assert r.n_failed == sum(x.failed & bit > 0 for x in rows)
        assert r.n_only == sum(x.failed == bit for x in rows)
    kept = rules.apply(book, "strict-1").filter("kept").count()
    assert kept == sum(x.failed == 0 for x in rows)


def test_rules_agree_with_quality_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    book = [r for r in queries.op5_rules(spark, sf).collect() if r.doc_id in labels and r.n_words >= 20]
    good = [r.kept for r in book if labels[r.doc_id] == 1]
    bad = [r.kept for r in book if labels[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.1


def plain_substrings(rows):
    """rows: (doc_id, text); a null doc_id is the last."""
    rank = [d if d is not None else 2**63 - 1 for d, _ in rows]
    first = {}
    for d, (_, text) in zip(rank, rows):
        words = WS.findall(text or "")
        for i in range(len(words) - 12):
            g = tuple(words[i : i + 13])
            first[g] = min(d, first.get(g, d))
    out = []
    for d, (doc_id, text) in zip(rank, rows):
        words = WS.findall(text or "")
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substrings_as_brute_force(spark):
    got = queries.op7_substrings(spark, SF).collect()
    expected = plain_substrings([(r["doc_id"], r["text"]) for r in table(spark, "documents")])
    assert sorted(map(tuple, got), key=str) == expected
    assert any(r.n_removed for r in got)


def test_substring_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(substring, "_CHUNK", 64)
    p = " ".join(f"p{i}" for i in range(20))
    q = " ".join(f"q{i}" for i in range(13))
    rows = [(9, f"a {p} b"), (3, p), (3, p), (3, f"{q} {p}"), (None, f"{q}  {q}"), (None, q), (7, None), (8, ""), (-5, f"{q}\n{p[:30]}"), (12, f"{p} {q} {p} z"), (11, "P0 " + p[3:]), (2, "r " * 40_000), (4, "r " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS places")
    for blocks in (1, 7):
        got = substring.deduplicated(docs, blocks=blocks).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == plain_substrings(rows)
    assert substring.deduplicated(docs.limit(0)).count() == 0


def test_factors_name_equal_words_of_their_reference(spark):
    texts = {r["doc_id"]: WS.findall(r["text"] or "") for r in table(spark, "documents")}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = longer = 0
    for r in substring.deduplicated(docs, blocks=5).collect():
        for s in r.spans:
            own, ref = texts[r.doc_id][s.first : s.end], texts[s.ref_doc][s.ref_first : s.ref_first + s.end - s.first]
            assert own == ref and len(own) >= 13 and s.ref_doc < r.doc_id
            n, longer = n + 1, longer + (len(own) > 13)
    assert n and longer > 0.3 * n


def test_windows_of_equal_hashes_are_not_removed(monkeypatch):
    """The tasks' functions one after the other, with hashes that collide."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, 60))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, "a " * 40), (201, "a " * 50)]
    plain = words.Chunk.windows
    monkeypatch.setattr(words.Chunk, "windows", lambda self, hashes, k: (lambda at, h: (at, h % np.uint64(1 << 16)))(*plain(self, hashes, k)))
    ids, texts = pa.array([d for d, _ in rows]), pa.array([t for _, t in rows])
    batch = pa.RecordBatch.from_arrays([ids, texts, pa.array(range(len(rows)), pa.int32())], names=["doc_id", "text", "key"])
    by = lambda t, name: {b: t.filter(pc.equal(t.column(name), b)) for b in set(t.column(name).to_pylist())}
    sent = pa.Table.from_batches(list(substring._send(iter([batch]), 13, 3)))
    assert sum(len(x) // 8 for x in sent.column("hashes").to_pylist() if x) > 100
    found = pa.concat_tables([substring._settle(t, 3) for t in by(sent, "block").values()])
    packed = pa.Table.from_batches(list(substring._packs(iter([batch]), 3)))
    probes = pa.concat_tables([substring._lone(t, 3) for t in by(found, "bucket").values()])
    asked = by(probes, "bucket")
    digests = pa.concat_tables([substring._digests(t, asked.get(b, probes.slice(0, 0)), 13) for b, t in by(packed, "bucket").items()]).to_pylist()
    told = {}
    for r in digests:
        told.setdefault((r["tag_doc"], r["tag_key"], r["tag_place"]), set()).add(r["digest"])
    bad = [tag for tag, seen in told.items() if len(seen) > 1]
    assert bad
    refuted = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*bad), (pa.int64(), pa.int32(), pa.int32()))], names=["tag_doc", "tag_key", "tag_place"])
    dealt = pa.Table.from_batches(list(substring._to_buckets(iter([refuted]), 3)))
    both = by(pa.concat_tables([found, dealt], promote_options="default"), "bucket")
    out = pa.concat_tables([substring._cut(t, both.get(b, found.slice(0, 0).append_column("tag_doc", pa.array([], pa.int64())).append_column("tag_key", pa.array([], pa.int32())).append_column("tag_place", pa.array([], pa.int32()))), 13) for b, t in by(packed, "bucket").items()])
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.to_pylist()), key=str)
    assert got == plain_substrings(rows)


def test_settled_windows_spread_over_the_blocks():
    """A third of the texts begin alike; no block gets much more of the settled windows than the others."""
    rng = np.random.default_rng(0)
    passage = " ".join(f"p{i}" for i in range(40))
    blocks, chunk = 8, 200
    settled = np.zeros(blocks, int)
    for lo in range(0, 64 * chunk, chunk):  # each batch is a chunk of its own
        texts = [(passage + " " if i % 3 == 0 else "") + " ".join(f"w{j}" for j in rng.integers(0, 10**9, 20)) for i in range(chunk)]
        batch = pa.RecordBatch.from_arrays([pa.array(range(lo, lo + chunk), pa.int64()), pa.array(texts), pa.array(range(chunk), pa.int32())], names=["doc_id", "text", "key"])
        for part in substring._send(iter([batch]), 13, blocks):
            for block, hashes in zip(part.column("block").to_pylist(), part.column("hashes").to_pylist(), strict=True):
                settled[block] += hashes is None
    assert settled.sum() == 64 and settled.max() <= 2.5 * settled.mean()
