"""Scans over ranges, chains, places and constrained clusters against plain loops."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carrel.operators import claims, clusters, guards, lines, ordering, scans
from carrel.sources import sinks


def test_scans_are_the_windows_over_whole_documents(spark):
    rng = random.Random(3)
    rows = [(doc, n, rng.choice([None, None, "", "a", "# b", "# c", "== s"])) for doc in ("x", "y", None) for n in rng.sample(range(-40, 400), 90)]
    table = spark.createDataFrame(rows, "doc string, line_no int, line string").selectExpr("*", "1 AS edge").repartition(3)
    down = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("doc").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("doc").orderBy("line_no").rowsBetween(1, Window.unboundedFollowing)
    value = F.when(F.col("line").startswith("#"), F.col("line"))
    expected = table.select("doc", "line_no", F.last(value, ignorenulls=True).over(down).alias("v"), F.last(value, ignorenulls=True).over(above).alias("before"), F.first(value, ignorenulls=True).over(below).alias("after"), F.sum(F.coalesce(value.isNotNull(), F.lit(False)).cast("long")).over(down).alias("n"))
    plain = sorted(map(tuple, expected.collect()), key=str)
    for span in (1, 7, 64, 1 << 16):
        got = scans.last_filled(table, value, "v", span=span)
        got = scans.last_filled(got, value, "before", strictly=True, span=span)
        got = scans.last_filled(got, value, "after", ahead=True, strictly=True, span=span)
        got = scans.running_sums(got, {"n": value.isNotNull().cast("int")}, span=span)
        assert got.columns == [*table.columns, "v", "before", "after", "n"]
        assert sorted(map(tuple, got.select("doc", "line_no", "v", "before", "after", "n").collect()), key=str) == plain
    assert scans.last_filled(table.limit(0), value, "v").count() == 0


def test_one_long_document_is_dealt_over_tasks(spark, monkeypatch):
    """No window over a document's lines: each range of a document of many is a task's own."""
    table = spark.range(40_000).select(F.lit("one").alias("doc"), F.col("id").alias("line_no"), F.when(F.col("id") % 1000 == 0, F.concat(F.lit("# "), F.col("id"))).otherwise("").alias("line"))
    monkeypatch.setattr(scans.last_filled, "__defaults__", (*scans.last_filled.__defaults__[:-1], 512))
    monkeypatch.setattr(scans.running_sums, "__defaults__", (*scans.running_sums.__defaults__[:-1], 512))
    found = lines.next_filled(lines.carried(table, F.when(F.col("line") != "", F.col("line")), "heading"))
    sizes = found.groupBy(F.spark_partition_id()).count().collect()
    wrong = found.filter((F.col("heading") != F.concat(F.lit("# "), F.floor(F.col("line_no") / 1000) * 1000)) | ~F.col("next_line").eqNullSafe(F.when(F.col("line_no") < 39_000, F.concat(F.lit("# "), (F.floor(F.col("line_no") / 1000) + 1) * 1000))))
    assert wrong.isEmpty() and len(sizes) > 1
    carded = lines.cards(table, F.col("line") != "")
    assert carded.filter((F.col("card") != F.floor(F.col("line_no") / 1000) + 1) | (F.col("at") != F.col("line_no") % 1000)).isEmpty()


def test_a_heading_is_forgotten_where_a_section_begins(spark):
    rows = [(1, "# a"), (2, "x"), (3, "=="), (4, "y"), (5, "# b"), (6, "== # c"), (7, "z")]
    table = spark.createDataFrame([("d", *r) for r in rows], "doc string, line_no int, line string")
    found = lines.carried(table, F.when(F.col("line").contains("#"), F.col("line")), "h", reset=F.col("line").startswith("=="))
    assert [r.h for r in found.orderBy("line_no").collect()] == ["# a", "# a", None, None, "# b", "== # c", "== # c"]


def test_chains(spark):
    schema = "verdict_id int, claim_id int, outcome string, supersedes int"
    rows = [(i, 1, "a", i - 1 if i else None) for i in range(21)] + [(100, 2, "a", None), (101, 2, "a", 102), (102, 2, "a", 101), (200, 3, "a", 999), (201, 3, "a", 200), (300, 4, "a", 300)]
    table = spark.createDataFrame(rows, schema)
    found = {r.verdict_id: (r.root, r.position) for r in claims.chains(table).collect()}
    assert found == {**{i: (0, i) for i in range(21)}, 100: (100, 0), **dict.fromkeys((101, 102, 200, 201, 300), (None, None))}
    claims.check_chains(table.filter("claim_id = 1"))
    ring = spark.createDataFrame([(1, 1, "a", None), (2, 1, "a", 1), (3, 1, "a", 4), (4, 1, "a", 3)], schema)
    with pytest.raises(guards.DataError, match="in a ring"):  # one root, one successor each, one tip
        claims.check_chains(ring)
    with pytest.raises(guards.DataError, match="not there"):
        claims.check_chains(spark.createDataFrame([(1, 1, "a", None), (2, 1, "a", 9)], schema))
    with pytest.raises(guards.DataError, match="another claim"):
        claims.check_chains(spark.createDataFrame([(1, 1, "a", None), (2, 2, "a", None), (3, 2, "a", 1)], schema))
    assert claims.chains(table.limit(0)).count() == 0
    same_time = spark.createDataFrame([("s", "p", v, "a", 1) for v in "xzy"], "subject string, predicate string, value string, actor string, decided_at int")
    assert claims.resolve(same_time, "a").first().value == "z"


def test_places_over_a_table(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["b", "a", None]), rng.randrange(5)) for i in range(500)]
    table = spark.createDataFrame(rows, "id int, name string, place_of int").repartition(6)
    got = ordering.placed(table, ["name", F.col("place_of") * -1, "id"])
    assert got.columns == [*table.columns, "place"]
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", -r[2], r[0]))
    assert {r.id: r.place for r in got.collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    assert ordering.placed(table.limit(0), ["id"]).count() == 0
    binned = spark.createDataFrame([("Ab", True), ("[x", False), (None, False), (" b", None), ("A", False)], "name string, last boolean")
    first = [r.name for r in ordering.placed(binned, ordering.binned("name", F.col("last"))).orderBy("place").collect()]
    assert first[:2] == ["A", " b"] and set(first[2:4]) == {"[x", None} and first[4] == "Ab"


def greedy(ids, links, cannot, keys, rank):
    group = {i: {i} for i in ids}
    refused = []
    for a, b, w in sorted(links, key=lambda x: (x[2], rank[x[0], x[1]], x[0], x[1]), reverse=True):
        if group[a] is group[b]:
            continue
        both = group[a] | group[b]
        held = [k for i in both for k in keys.get(i, ())]
        if any(x in both and y in both for x, y in cannot) or len(held) > len(set(held)):
            refused.append((a, b))
            continue
        for i in both:
            group[i] = both
    return {i: min(group[i]) for i in ids}, refused


def test_constrained_clusters_as_one_link_after_another(spark):
    for seed in range(3):
        rng = random.Random(seed)
        ids = list(range(40))
        links = {(a, b): float(rng.randrange(4)) for a, b in (sorted(rng.sample(ids, 2)) for _ in range(45))}
        cannot = [tuple(rng.sample(ids, 2)) for _ in range(12)]
        keys = {i: [f"k{rng.randrange(12)}"] for i in ids if rng.random() < 0.5}
        nodes = spark.createDataFrame([(i,) for i in ids], "id int")
        rows = spark.createDataFrame([(a, b, w) for (a, b), w in links.items()] + [(1, 1, 9.0), (2, 99, 9.0), (None, 3, 9.0)], "a int, b int, weight double")
        rank = {(r.a, r.b): r.h for r in rows.select("a", "b", F.xxhash64("a", "b").alias("h")).collect()}
        found, refused = clusters.constrained(nodes, rows, spark.createDataFrame([*cannot, (5, 5)], "a int, b int"), spark.createDataFrame([(i, k) for i, own in keys.items() for k in own], "id int, key string"))
        expected, gone = greedy(ids, [(a, b, w) for (a, b), w in links.items()], cannot, keys, rank)
        assert {r.id: r.cluster for r in found.collect()} == expected
        got = {(r.a, r.b) for r in refused.collect()}
        inside = {(a, b) for a, b in gone if expected[a] == expected[b]}
        assert not inside and got == set(gone)


def test_a_section_of_a_log_is_replaced(spark):
    log = spark.createDataFrame([(1, "a"), (2, "## s"), (3, "old"), (4, "## s"), (5, "b")], "line_no int, line string")
    section = spark.createDataFrame([(1, "new")], "line_no long, line string")
    once = sinks.section_replaced(log, "## s", section)
    text = lambda df: [r.line for r in df.orderBy("line_no").collect()]
    assert text(once) == ["a", "## s", "new"] == text(sinks.section_replaced(once, "## s", section))
    assert text(sinks.section_replaced(log.limit(1), "## s", section)) == ["a", "## s", "new"]
