"""Claims: one row for each statement a record makes, with verdicts that supersede one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.functions.claims import place_role
from carrel.operators.guards import fail_if_any
from carrel.sources.staging import stage


def reify(rows: DataFrame, subject: str, predicates: list[str], actor: str) -> DataFrame:
    """(subject, predicate, value, actor) for each filled field; values as text."""
    cells = F.explode(F.array(*(F.struct(F.lit(p).alias("predicate"), F.col(p).cast("string").alias("value")) for p in predicates))).alias("c")
    return rows.select(F.col(subject).alias("subject"), cells, F.col(actor).alias("actor")).select("subject", "c.predicate", "c.value", "actor").filter("value is not null")


def tips(verdicts: DataFrame) -> DataFrame:
    """Verdicts that no other one supersedes."""
    replaced = verdicts.filter("supersedes is not null").select(F.col("supersedes").alias("verdict_id")).distinct()
    return verdicts.join(replaced, "verdict_id", "left_anti")


def chains(verdicts: DataFrame) -> DataFrame:
    """(verdict_id, claim_id, root, position): the first verdict of each one's chain and how many come before it.

    Every verdict looks at the one it supersedes, then at what that one has found, so it sees twice as
    far each round. root and position are null where the way back never ends, in a ring, or leads to a verdict that is
    not there. Verdicts that supersede the same one are on different chains.
    """
    told = verdicts.select("verdict_id", "claim_id", F.coalesce("supersedes", "verdict_id").alias("at"), F.col("supersedes").isNotNull().cast("long").alias("steps"), F.col("supersedes").isNull().alias("ended"))
    now = stage(told, "chains")
    left = now.filter("not ended").count()
    while left:
        seen = now.select(F.col("verdict_id").alias("_id"), F.col("at").alias("_at"), F.col("steps").alias("_steps"), F.col("ended").alias("_ended"))
        onward = now.filter("not ended").join(seen, F.col("at") == F.col("_id"), "left")
        # a verdict that isn't there ends the way without a root
        lost = F.col("_id").isNull()
        moved = onward.select("verdict_id", "claim_id", F.when(~lost, F.col("_at")).alias("at"), F.when(~lost, F.col("steps") + F.col("_steps")).alias("steps"), F.coalesce("_ended", F.lit(True)).alias("ended"))
        now = stage(now.filter("ended").unionByName(moved), "chains")
        before, left = left, now.filter("not ended").count()
        if left == before:  # of a chain the nearest to the root would have ended
            break
    return now.select("verdict_id", "claim_id", F.when(F.col("ended"), F.col("at")).alias("root"), F.when(F.col("ended"), F.col("steps")).alias("position"))


def check_chains(verdicts: DataFrame) -> None:
    """Fails unless each claim's verdicts form one chain: one root, one successor each, connected and without rings."""
    fail_if_any(verdicts.filter("supersedes is not null").groupBy("supersedes").count().filter("count > 1"), "a verdict has several successors")
    per = verdicts.groupBy("claim_id").agg(F.count_if(F.col("supersedes").isNull()).alias("roots"))
    fail_if_any(per.filter("roots <> 1"), "a claim without one first verdict")
    placed = chains(verdicts)
    fail_if_any(placed.filter("root is null"), "a verdict in a ring, or behind one that is not there")
    roots = verdicts.select(F.col("verdict_id").alias("root"), F.col("claim_id").alias("_claim"))
    fail_if_any(placed.join(roots, "root").filter(~F.col("claim_id").eqNullSafe(F.col("_claim"))), "a verdict in the chain of another claim")


def shortcuts(claims: DataFrame, verdicts: DataFrame, human: str = "human") -> DataFrame:
    """(subject, predicate, value) of claims by people, and of those whose last verdict approves."""
    good = tips(verdicts).filter("outcome = 'approved'").select("claim_id").distinct()
    by_people = claims.filter(F.col("actor") == human)
    approved = claims.filter(F.col("actor") != human).join(good, "claim_id", "left_semi")
    return by_people.unionByName(approved).select("subject", "predicate", "value").distinct()


def symmetric(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs with their mirrors, each once."""
    return pairs.select(a, b).unionByName(pairs.select(F.col(b).alias(a), F.col(a).alias(b))).distinct()


def sharing(rows: DataFrame, id_: str, value: str) -> DataFrame:
    """(a, b), both ways, of different ids that share a value."""
    left = rows.select(F.col(id_).alias("a"), F.col(value).alias("_v")).distinct()
    right = rows.select(F.col(id_).alias("b"), F.col(value).alias("_v")).distinct()
    return left.join(right, "_v").filter("a <> b").select("a", "b").distinct()


def sharing_groups(rows: DataFrame, id_: str, value: str) -> DataFrame:
    """(id, group, n): those that share a value as members of a group named by its smallest id.

    The same pairs as ``sharing`` says, a row for each member instead of one for each pair, so that a
    value with very many ids costs no more than these.
    """
    one = rows.filter(F.col(value).isNotNull()).select(F.col(id_).alias("id"), F.col(value).alias("_v")).distinct()
    groups = one.groupBy("_v").agg(F.min("id").alias("group"), F.count("*").alias("n")).filter("n > 1")
    return one.join(groups, "_v").select("id", "group", "n")


def resolve(claims: DataFrame, prefer: str, order: str = "decided_at") -> DataFrame:
    """(subject, predicate, value): the preferred actor's last value (of one time the greatest), else the only one said.

    Several values without a preferred one fail.
    """
    own = F.col("actor") == prefer
    per = claims.groupBy("subject", "predicate").agg(
        F.max_by(F.when(own, F.col("value")), F.when(own & F.col(order).isNotNull(), F.struct(order, "value"))).alias("chosen"),
        F.count_distinct("value").alias("n"),
        F.min("value").alias("any"),
    )
    fail_if_any(per.filter("chosen is null and n > 1"), "several values and no preferred one")
    return per.select("subject", "predicate", F.coalesce("chosen", "any").alias("value"))


def places_by_role(places: DataFrame, id_: str, label: str, site: str) -> DataFrame:
    """(id, production, findspot, certainty): where a thing was made and where it was found, never mixed.

    Of several places of one kind the most certain counts, then the first by its letters.
    """
    said = F.col("_r.certainty")
    rank = F.when(said == "confirmed", 0).when(said == "probable", 1).when(said == "uncertain", 2).otherwise(3)
    told = places.select(F.col(id_).alias("id"), F.col(site).alias("site"), place_role(label).alias("_r")).filter("_r.kind is not null and site is not null")
    best = lambda kind: F.min(F.when(F.col("_r.kind") == kind, F.struct(rank.alias("rank"), "site", F.col("_r.certainty").alias("certainty"))))
    return told.groupBy("id").agg(best("production").alias("p"), best("findspot").alias("f")).select("id", F.col("p.site").alias("production"), F.col("f.site").alias("findspot"), F.col("f.certainty").alias("certainty"))
