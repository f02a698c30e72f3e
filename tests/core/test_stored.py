"""Stored tables, snapshots, trees, line sources and raw JSON against plain loops."""

import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.operators import consensus, guards, joins, search, trees
from carrel.sources import landed, snapshots


def table(spark, ids, change=0):
    return spark.createDataFrame([(i, f"v{i + change}") for i in ids], "id long, v string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_an_upsert_rewrites_its_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = snapshots.create(table(spark, range(2000)), path, ["id"], buckets=50)
    files = {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/data") for f in fs if f.endswith(".parquet")}
    told = snapshots.upsert(table(spark, [3, 5, 5000], 7), path)
    assert 1 <= len(told["rewritten"]) <= 3
    assert {b for b, f in told["folders"].items() if f != first["folders"].get(b)} == set(told["rewritten"])
    added = {os.path.join(d, f) for d, _, fs in os.walk(f"{path}/data") for f in fs if f.endswith(".parquet")} - files
    assert {os.path.basename(os.path.dirname(f)) for f in added} == {f"_bucket={b}" for b in told["rewritten"]}
    expected = {i: f"v{i}" for i in range(2000)} | {i: f"v{i + 7}" for i in (3, 5, 5000)}
    assert dict(rows(snapshots.read(spark, snapshots.manifest(spark, path)))) == expected
    assert rows(snapshots.read(spark, first)) == rows(table(spark, range(2000)))  # who reads the old version keeps it
    with pytest.raises(guards.DataError, match="another upsert was first"):
        snapshots.upsert(table(spark, [9], 1), path, base=first)
    assert dict(rows(snapshots.read(spark, snapshots.manifest(spark, path)))) == expected
    assert snapshots.upsert(table(spark, []), path)["version"] == 1
    for bad in (table(spark, [1, 1]), table(spark, [None] if False else [1]).withColumn("id", F.lit(None).cast("long"))):
        with pytest.raises(guards.DataError):
            snapshots.upsert(bad, path)
    empty = snapshots.create(table(spark, []), f"{tmp_path}/e", ["id"])
    assert rows(snapshots.read(spark, empty)) == []
    with pytest.raises(guards.DataError, match="no version"):
        snapshots.manifest(spark, f"{tmp_path}/none")


def test_snapshots_differ_where_rows_do(spark, tmp_path, monkeypatch):
    old, new = f"{tmp_path}/old", f"{tmp_path}/new"
    before = table(spark, range(1500))
    after = table(spark, [i for i in range(1500) if i not in (4, 900)]).withColumn("v", F.when(F.col("id") == 77, F.lit(None)).otherwise(F.col("v"))).unionByName(table(spark, [9999]))
    snapshots.snapshot(before, old, ["id"], levels=2)
    snapshots.snapshot(after.repartition(5), new, ["id"], levels=2)
    expected = [(4, "removed"), (77, "changed"), (900, "removed"), (9999, "added")]
    assert sorted(map(tuple, snapshots.changes(spark, old, new).collect())) == expected
    assert snapshots.differing_leaves(spark, old, new).count() <= 4
    again = f"{tmp_path}/again"
    snapshots.snapshot(before.repartition(3), again, ["id"], levels=2)
    assert snapshots.differing_leaves(spark, old, again).isEmpty() and snapshots.changes(spark, old, again).isEmpty()
    monkeypatch.setattr(snapshots, "ASKED", 0)
    assert sorted(map(tuple, snapshots.changes(spark, old, new).collect())) == expected
    empty = f"{tmp_path}/empty"
    snapshots.snapshot(table(spark, []), empty, ["id"], levels=2)
    assert snapshots.changes(spark, empty, old).filter("change <> 'added'").isEmpty() and snapshots.changes(spark, empty, old).count() == 1500


def test_a_numbered_tree_holds_what_is_below(spark):
    rng = random.Random(4)
    parents = {0: None, 100: None} | {i: rng.choice([*range(i), 100]) if rng.random() < 0.6 else 0 for i in range(1, 60)}
    edges = spark.createDataFrame(list(parents.items()), "node int, parent int")
    reach = trees.closure(edges, "node", "parent", lambda df, i: df.cache(), most_levels=64)
    tree = {r.node: r for r in trees.numbered(edges, "node", "parent", reach).collect()}

    def above(n):
        return [] if n is None else [n, *above(parents[n])]

    assert sorted(r.first for r in tree.values()) == list(range(len(parents)))
    for a in parents:
        for b in parents:
            assert (tree[a].first <= tree[b].first <= tree[a].last) == (a in above(b))
    made = spark.createDataFrame([tuple(r) for r in tree.values()], "node int, depth int, first long, last long")
    for depth in (0, 1, 3):
        expected = sorted((n, next(x for x in above(n) if len(above(x)) - 1 == depth)) for n in parents if len(above(n)) > depth)
        assert sorted(map(tuple, trees.below(made, depth).collect())) == expected


def test_line_numbers_of_files_in_many_blocks(spark, tmp_path):
    texts = {"a.jsonl": '{"k": 1}\r\n\r\n{"k": 2}\r\n' + "\n".join(f'{{"k": {i}}}' for i in range(3, 90)), "b.jsonl": "\n\n" + '{"k": 1}\n' * 1 + "\n", "c.jsonl": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        got = {(os.path.basename(r.file), r.line_no): r.value for r in landed.numbered_lines(spark, f"{tmp_path}/*.jsonl").collect()}
        expected = {(name, i): line for name, text in texts.items() for i, line in enumerate(text.splitlines(), 1)}
        assert got == expected
        kind = T.StructType([T.StructField("k", T.IntegerType())])
        assert landed.json_lines(spark, f"{tmp_path}/*.jsonl", kind, ["k"]).count() == 90
        (tmp_path / "d.jsonl").write_text('{"k": 5}\n\n' + "".join(f'{{"k": {i}}}\n' for i in range(6, 40)) + '{"k": 5}')
        with pytest.raises(guards.DataError, match="'first_line': 1, 'last_line': 37"):
            landed.json_lines(spark, f"{tmp_path}/*.jsonl", kind, ["k"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_names_of_agents_and_arrays(spark, tmp_path):
    names = spark.createDataFrame([("agent-a-part.jsonl",), ("agent-b.jsonl",), ("notes.jsonl",)], "file string")
    assert [r.a and tuple(r.a) for r in names.select(landed.agent_of("file").alias("a")).collect()] == [("a", "part"), ("b", None), None]
    assert [r.a and tuple(r.a) for r in names.select(landed.agent_of("file", chunked=True).alias("a")).collect()] == [("a", "part"), None, None]
    (tmp_path / "x.json").write_text('[{"k": 1},\n {"k": null}]')
    kind = T.StructType([T.StructField("k", T.IntegerType())])
    assert [r.k for r in landed.json_array(spark, str(tmp_path), kind).collect()] == [1, None]
    (tmp_path / "x.json").write_text('[{"k": "one"}]')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed|CAST|FAILFAST"):
        landed.json_array(spark, str(tmp_path), kind).collect()


def test_raw_json_values_vote_by_their_canonical_text(spark):
    said = [
        (1, "a", '{"n": 1, "deep": {"y": [1, {"b": 2, "a": "é"}], "x": null}, "only": "unknown"}'),
        (1, "b", '{"deep": {"x": "N/A", "y": [1, {"a": "\\u00e9", "b": 2}]}, "n": 1.0}'),
        (1, "c", '{"n": 1.0, "deep": 3}'),
        (2, "a", "{}"),
        (3, "a", '{"n": 1e2, "t": " — "}'),
        (3, "b", '{"n": 100.0, "t": true, "": "x"}'),
    ]
    votes = consensus.raw_votes(spark.createDataFrame(said, "key int, agent string, data string"), ["key"], "agent", "data")
    got = {(r.key, r.agent, r.field): r.value for r in votes.collect()}
    deep = '{"x": null, "y": [1, {"a": "é", "b": 2}]}'
    assert got == {
        (1, "a", "n"): "1", (1, "b", "n"): "1.0", (1, "c", "n"): "1.0",
        (1, "a", "deep"): deep, (1, "b", "deep"): deep, (1, "c", "deep"): "3",
        (1, "a", "only"): "null", (1, "b", "only"): "null", (1, "c", "only"): "null",
        (3, "a", "n"): "100.0", (3, "b", "n"): "100.0", (3, "a", "t"): "null", (3, "b", "t"): "true", (3, "a", ""): "null", (3, "b", ""): '"x"',
    }
    with pytest.raises(Exception, match="JSONDecodeError|Expecting"):
        consensus.raw_votes(spark.createDataFrame([(1, "a", "{")], "key int, agent string, data string"), ["key"], "agent", "data").collect()


def test_a_review_log_counts_a_batch_once(spark, tmp_path):
    batch = spark.createDataFrame([(1, "pending", 1), (2, "accepted", 5)], "mention long, status string, at long")
    for name in ("a", "a"):
        joins.record_verdicts(batch, f"{tmp_path}/log", name)
    joins.record_verdicts(spark.createDataFrame([(1, "rejected", 4), (2, "pending", 5)], batch.schema), f"{tmp_path}/log", "b")
    assert rows(joins.folded(spark, f"{tmp_path}/log")) == [(1, "rejected", 4, 2), (2, "pending", 5, 2)]
    with pytest.raises(guards.DataError, match="malformed"):
        joins.record_verdicts(batch, f"{tmp_path}/log", "../x")


def test_facets_of_any_filters_from_bitmaps(spark):
    rng = random.Random(7)
    some = [(i * 37, rng.choice(["a", "b", None]), [rng.choice("xyz") for _ in range(rng.randrange(4))], rng.randrange(3)) for i in range(2500)]  # three blocks
    table = spark.createDataFrame(some, "id long, kind string, tags array<string>, size int")
    index = search.facet_index(table, "id", ["kind", "tags", "size"]).cache()
    for filters in ({}, {"kind": "a"}, {"kind": "b", "size": "1"}, {"tags": "x", "kind": "a", "size": "2"}, {"kind": "none"}):
        own = search.filtered(table.withColumn("size", F.col("size").cast("string")).withColumn("tags", F.array_distinct("tags")), search.Query(filters=filters))
        assert rows(search.facet_counts(index, filters)) == rows(search.facets(own, ["kind", "tags", "size"]))
