"""Joins and aggregates whose work must not grow faster than their rows."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from carrel.operators import clusters, consensus, guards, joins
from carrel.plans import votes
from carrel.sources import staging
from carrel.sources.staging import stage


def test_narrowed_pairs_are_made_once_and_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(joins, "_PART_MENTIONS", 7, raising=False)
    mentions = [(i, "son", "a", "Ra") for i in range(40)] + [(5, "son", "b", "Ra"), (5, "son", "a", "RA"), (50, "son", "c", "Ra"), (51, None, "a", "Ra"), (52, "son", "a", None), (None, "son", "b", "Ra")]
    claims = [(s, "son", v) for s in range(30) for v in ("a", "b")] + [(3, "son", "a"), (4, None, "a")]
    names = [(s, " ra ") for s in range(30)] + [(1, "Ra"), (2, None)]
    made = [spark.createDataFrame(rows, kind) for rows, kind in ((mentions, "id long, predicate string, value string, name string"), (claims, "subject long, predicate string, value string"), (names, "subject long, name string"))]
    found = joins.narrowed(*made)
    rows = sorted((r.mention if r.mention is not None else -1, r.subject) for r in found.collect())
    assert rows == sorted((m, s) for m in [*range(40), -1] for s in range(30))
    top = found.filter(F.lit(True))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any(line.strip(" +-:").startswith(("Aggregate", "Deduplicate")) for line in top[:2]), top[:2]


def written_by_shuffles(spark, since=-1):
    """Bytes, and the last stage so far."""
    sc, jvm = spark.sparkContext._jsc.sc(), spark.sparkContext._jvm
    sc.listenerBus().waitUntilEmpty()
    found = sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    stages = [found.apply(i) for i in range(found.size())]
    return sum(x.shuffleWriteBytes() for x in stages if x.stageId() > since), max((x.stageId() for x in stages), default=-1)


def test_narrowed_shuffles_numbers_and_keeps_mentions_of_a_question_together(spark, monkeypatch):
    monkeypatch.setattr(joins, "_PART_MENTIONS", 50)
    rng = random.Random(4)
    said = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3000)) for _ in range(20)]
    mentions = [(i, "son", str(i % 2), said[i % 20].upper()) for i in range(3000)]
    mentions += [(i, "son", v, said[j]) for i in range(3000, 3040) for j in (i % 7, i % 3, 9) for v in "01"]
    claims, names = [(s, "son", str(s % 2)) for s in range(200)], [(s, said[s * 7 % 20]) for s in range(200)]
    made = [spark.createDataFrame(rows, kind) for rows, kind in ((mentions, "id long, predicate string, value string, name string"), (claims, "subject long, predicate string, value string"), (names, "subject long, name string"))]
    before = written_by_shuffles(spark)[1]
    rows = joins.narrowed(*made).select("mention", "subject", F.spark_partition_id()).collect()
    assert written_by_shuffles(spark, before)[0] < 2_000_000  # a name of each mention would be 9 MB
    assert sorted(r[:2] for r in rows) == sorted({(m, s) for m, _, v, n in mentions for s in range(int(v), 200, 2) if said[s * 7 % 20] == n.lower()})
    asked = [(r[2], r.mention % 20) for r in rows if r.mention < 3000]
    assert len([x for x, _ in itertools.groupby(asked)]) == len(set(asked))


def test_labels_are_not_sent_through_the_driver(spark, monkeypatch):
    plans = []

    def saved(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, str(name))

    nodes = spark.range(60)
    links = nodes.filter("id % 3 > 0").selectExpr("id - 1 AS a", "id AS b")
    got = {r.id: r.cluster for r in clusters.min_label(nodes, links, saved).collect()}
    assert got == {i: i // 3 * 3 for i in range(60)}
    monkeypatch.setattr(clusters, "stage", saved)
    cannot = spark.createDataFrame([(0, 2), (3, 5)], "a long, b long")
    found = clusters.constrained(nodes, links.selectExpr("*", "b AS weight"), cannot)[0]
    assert {r.id: r.cluster for r in found.collect()} == {i: i // 3 * 3 if i not in (0, 3) else i for i in range(60)} | {1: 1, 2: 1, 4: 4, 5: 4}
    assert len(plans) > 10 and not [p for p in plans if "BroadcastHashJoin" in p]


def test_pairs_and_mirrors_meet_in_one_aggregate_dealt_by_rows(spark):
    pairs = [(1, 2), (2, 1), (3, 4), (3, 4), (6, 5), (7, 7), (None, 5), (5, None), (5, 5), (None, None), (None, None)]
    rows = spark.createDataFrame(pairs, "a long, b long")
    for tasks in (None, 3):
        found = guards.unsymmetric(rows, "a", "b", tasks)
        assert sorted(found.collect(), key=str) == sorted([(3, 4), (6, 5), (None, 5), (5, None), (None, None)], key=str)
        assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
        assert tasks is None or found.rdd.getNumPartitions() == tasks


@pytest.mark.parametrize("name", ["vote_majority", "vote_disagreements", "vote_override"])
def test_votes_are_dealt_over_tasks_by_the_number_of_rows(spark, monkeypatch, name):
    monkeypatch.setattr(staging, "TASK_ROWS", 500, raising=False)
    sf_dir = "/root/testdata/sf0.001"
    tasks = -(-spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() // 500)
    plan = getattr(votes, name)(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(.*?, (\d+)\)", plan)
    assert dealt and set(dealt) == {str(tasks)}


def test_a_tie_is_told_from_one_winner(spark):
    said = {1: "aab", 2: "ab", 3: "bba", 4: "abc", 5: "a", 6: "aabbc"}
    cast = spark.createDataFrame([(k, f"agent{i}", "f", v) for k, text in said.items() for i, v in enumerate(text)], "key int, agent string, field string, value string")
    found = {r.key: (r.value, r.n, r.present, r.tied) for r in consensus.decide(consensus.tally(cast, ["key"]), ["key"]).collect()}
    assert found == {1: ("a", 2, 3, False), 2: ("a", 1, 2, True), 3: ("b", 2, 3, False), 4: ("a", 1, 3, True), 5: ("a", 1, 1, False), 6: ("a", 2, 5, True)}
