"""The stored search index against a scan of all rows."""

import random
import re

import pytest

from carrel.operators import postings, search

FIELDS = {"title": 4.0, "place": 1.5}


def near(a, b, most):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1] <= most


def by_scan(rows, query):
    words = query.words()
    out = []
    for id_, *texts in rows:
        fields = [(t or "").lower().split() for t in texts]
        score, every = 0.0, bool(words)
        for i, w in enumerate(words):
            fits = lambda t, w=w, i=i: near(t, w, query.typos) or (query.prefix and i == len(words) - 1 and t.startswith(w))
            own = sum(weight for field, weight in zip(fields, FIELDS.values(), strict=True) if any(map(fits, field)))
            score, every = score + own, every and own > 0
        if every:
            out.append((id_, score))
    return sorted(out)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["".join(rng.choice("abé漢") for _ in range(rng.randrange(1, 7))) for _ in range(60)] + ["common"]
    text = lambda: rng.choice([None, "", " ".join(rng.choices(words, k=rng.randrange(1, 9)) + ["common"] * rng.randrange(2))])
    ids = [*range(300), *(10**12 + 977 * i for i in range(200)), -5]  # dense ids and ids far apart
    rows = [(i, text(), text()) for i in ids]
    table = spark.createDataFrame(rows, "id long, title string, place string").selectExpr("*", "1 AS token", "2 AS span")
    path = str(tmp_path_factory.mktemp("index"))
    index = postings.write(table.repartition(5), "id", FIELDS, f"{path}/made", edits=2)
    return rows, words, table, index


def test_searches_from_the_index_are_those_of_a_scan(spark, stored):
    rows, words, table, index = stored
    assert postings.opened(spark, index.path) == index
    rng = random.Random(9)
    for n in range(6):
        text = " ".join(rng.sample(words, 1 + n % 3))
        if n % 2:
            text = text[1:] + "b"
        query = search.Query(text.upper(), typos=n % 3, prefix=n % 4 == 0)
        expected = by_scan(rows, query)
        assert sorted(map(tuple, postings.found(spark, index, query).collect())) == expected
        assert sorted((r.id, r.score) for r in search.hits(table, "id", FIELDS, query).select("id", "score").collect()) == expected
        for k in (1, 7):
            assert [tuple(r) for r in postings.best(spark, index, query, k).collect()] == sorted(expected, key=lambda r: (-r[1], r[0]))[:k]


def test_bounds_and_many_words_change_nothing(spark, stored, monkeypatch):
    rows, words, _, index = stored
    monkeypatch.setattr(postings, "OPENED_FIRST", 1)
    monkeypatch.setattr(postings, "WORDS_SENT", 0)
    for text in ("common", "common a"):
        query = search.Query(text, typos=1, prefix=True)
        expected = by_scan(rows, query)
        assert sorted(map(tuple, postings.found(spark, index, query).collect())) == expected
        assert [tuple(r) for r in postings.best(spark, index, query, 3).collect()] == sorted(expected, key=lambda r: (-r[1], r[0]))[:3]


def test_every_word_within_the_edits_is_met():
    rng = random.Random(2)
    for _ in range(3000):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(7)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(7)))
        for edits in (0, 1, 2):
            if near(a, b, edits):
                assert set(postings.variants_of(a, edits)) & set(postings.variants_of(b, edits))


def test_a_search_reads_its_words_alone(spark, stored):
    spark.conf.set("spark.sql.debug.maxToStringFields", "500")
    plan = postings._blocks(spark, stored[3], search.Query("common"))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*shard#", scan) and re.search(r"PushedFilters: \[[^\]]*\(token,", scan)


def test_odd_indexes(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, title string")
    index = postings.write(empty, "id", {"title": 1.0}, f"{tmp_path}/empty")
    assert postings.found(spark, index, search.Query("a", typos=1, prefix=True)).count() == 0
    assert postings.best(spark, index, search.Query("a"), 5).count() == 0
    assert postings.found(spark, index, search.Query(" !")).count() == 0
    with pytest.raises(ValueError, match="1 edits"):
        postings.matching(spark, index, search.Query("a", typos=2))
    twice = spark.createDataFrame([(1, "a"), (1, "a b"), (None, "a"), (2, "b " * 50_000)], "id long, title string")
    index = postings.write(twice, "id", {"title": 1.0}, f"{tmp_path}/twice")
    assert sorted(map(tuple, postings.found(spark, index, search.Query("a b")).collect())) == [(1, 2.0)]
    assert sorted(map(tuple, postings.found(spark, index, search.Query("b")).collect())) == [(1, 1.0), (2, 1.0)]


def test_words_of_an_only_field_are_not_looked_up_among_all_of_a_row(spark, monkeypatch, tmp_path):
    rows = spark.createDataFrame([(1, "red Red blue"), (2, None), (3, "red"), (4, "")], "id long, text string")

    def refused(*_):
        raise AssertionError("each word is sought among all words of its row")

    with monkeypatch.context() as patch:
        patch.setattr(postings.F, "array_contains", refused)
        index = postings.write(rows, "id", {"text": 2.0}, str(tmp_path / "only"))
    assert {tuple(r) for r in postings.found(spark, index, search.Query("red")).collect()} == {(1, 2.0), (3, 2.0)}
    assert {tuple(r) for r in postings.found(spark, index, search.Query("red blue")).collect()} == {(1, 4.0)}
