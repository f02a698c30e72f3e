"""The corpus pipeline, stage by stage, each against a brute-force version on its own input."""

import zlib

import corpus_pipeline
import numpy as np
import pytest
from carrel.llm import decontaminate, quality, queries
from carrel.sources.staging import stage

from tests.llm.test_first_five import shingles
from tests.llm.test_near_copies import kept_by_all_pairs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) of each stage, written and read again as the runner does."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, function in corpus_pipeline.STAGES:
        made = stage(function(spark, docs, SF), name.replace(" ", "-"))
        out.append((docs.collect(), made.collect(), made))
        docs = made
    return out


def test_columns_stay(spark, stages):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    assert [made.columns for _, _, made in stages[:-1]] == [columns] * 4


def test_classifier_drops_what_it_scores_low(spark, stages):
    given, kept, _ = stages[0]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in given if scores[r.doc_id] >= quality.KEEP)
    clean = {r.doc_id for r in labels.collect() if r.quality == 1}
    assert len(clean & {r.doc_id for r in kept}) > 0.97 * len(clean) and len(kept) < len(given)


def test_one_of_each_group_of_near_duplicates_stays(stages):
    given, kept, _ = stages[1]
    expected = kept_by_all_pairs([(r.doc_id, r.text) for r in given])
    assert sorted(r.doc_id for r in kept) == sorted(d for d, _ in expected) and len(kept) < len(given)
    assert {tuple(r) for r in kept} <= {tuple(r) for r in given}


def test_leaked_documents_go(spark, stages):
    given, kept, _ = stages[2]
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {r.doc_id for r in given for i in items if i and len(i & shingles(r.text)) >= decontaminate.needed(len(i), 0.8)}
    assert sorted(r.doc_id for r in kept) == sorted({r.doc_id for r in given} - leaked) and leaked


def test_the_mix_takes_what_it_plans(spark, stages):
    given, mixed, _ = stages[3]
    size = lambda r: len((r.text or "").encode().split())
    texts = {r.doc_id: r.text.split() for r in given}
    total = sum(map(size, given))
    taken, by = {}, {}
    for r in mixed:
        own = r.text.split()
        assert own == texts[r.doc_id][: len(own)] and own
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(own)
        by[r.source] = by.get(r.source, 0) + len(own)
    assert all(n <= 2 * len(texts[d]) for d, n in taken.items())
    sizes = {}
    for r in given:
        sizes[r.source] = sizes.get(r.source, 0) + size(r)
    names = sorted((s for s in sizes), key=lambda s: s.encode())
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, level = set(), 0.0
    while True:
        free = [s for s in names if s not in held]
        level = (1.5 * total - sum(2 * sizes[s] for s in held)) / sum(weights[s] for s in free) if free else 0.0
        over = {s for s in free if 2 * sizes[s] < level * weights[s]}
        if not over:
            break
        held |= over
    assert all(abs(by.get(s, 0) - (2 * sizes[s] if s in held else level * weights[s])) < 1 for s in names)


def test_tokens_are_those_of_the_mix(stages):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.TOKENIZER)
    given, out, _ = stages[4]
    expected = []
    for r in given:
        ids = np.array(plain.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        expected.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    ordered = sorted(out, key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in ordered) == sorted(expected)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in ordered)


def test_the_whole_run_agrees(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][1]))


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty, repeated and very long texts, one id with several texts, clashing columns."""
    words = " ".join(f"w{i}" for i in range(400))
    item = "this item of the benchmark should stand in no document"
    rows = [(None, None, None, None, None), (None, "", "en", "a", 0), (1, words, "en", "a", 9), (1, words, "en", "a", 9), (1, words + " more", None, "b", None), (2, words + " more still", "en", None, 1)]
    rows += [(3, f"{item} {words[::-1]}", "en", "b", 3), (3, "another text of the same id that is clean", "en", "b", 3), (None, f"x {item} y", "en", "b", 3), (None, "a clean text without an id, which stays", "en", "c", 3), (4, "long " * 50_000, "en", "a", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "7 AS _key", "8 AS _leaked", "9 AS size", "text AS key")
    spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = []
    now = docs
    for name, function in corpus_pipeline.STAGES[:-1]:
        made = stage(function(spark, now, str(tmp_path)), "odd")
        assert made.columns == docs.columns, name
        found.append(sorted(((r.doc_id, r.text) for r in made.collect()), key=str))
        assert all((r["_key"], r["_leaked"], r["size"], r["key"]) == (7, 8, 9, r.text) for r in made.collect() if name != "mixing sources")
        now = made
    classified, deduplicated, cleaned, mixed = found
    assert len(classified) == len(rows)  # one labelled document, of good quality
    assert deduplicated == sorted({(r[0], r[1]) for r in rows} - {(None, None), (1, words + " more"), (2, words + " more still")}, key=str)
    assert (3, rows[6][1]) not in cleaned and (3, rows[7][1]) in cleaned and (None, rows[9][1]) in cleaned and (None, rows[8][1]) not in cleaned
    assert {t for _, t in mixed if t} and all(t for _, t in mixed)
    last = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
    assert len(last) == len(mixed)
    for empty in (docs.limit(0),):
        for _, function in corpus_pipeline.STAGES:
            assert function(spark, empty, str(tmp_path)).count() == 0
