"""Corrections: cells set by key, keys and columns renamed, values moved to a new vocabulary, defaults."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.functions.text import looked_up
from carrel.operators.guards import fail_if_any, orphans, repeated_keys
from carrel.sources.sinks import audit


def patch_cells(rows: DataFrame, key: str, patches: DataFrame, order: str | None = None) -> DataFrame:
    """Sets cells to those of patches (key, field, value as text or null).

    With ``order`` the last patch of a cell wins, without it a cell patched twice fails; so do an
    unknown key and an unknown field. A patch to null sets null.
    """
    kinds = {f.name: f.dataType for f in rows.schema}
    fail_if_any(patches.filter(~F.col("field").isin(*kinds)), "a patch of an unknown field")
    fail_if_any(orphans(patches, "key", rows, key), "a patch of an unknown key")
    if order is None:
        fail_if_any(repeated_keys(patches, ["key", "field"]), "a cell is patched twice")
        last = patches.select("key", "field", F.struct("value").alias("p"))
    else:
        last = patches.groupBy("key", "field").agg(F.max_by(F.struct("value"), order).alias("p"))
    fields = [f for f in kinds if f != key]
    wide = last.groupBy("key").pivot("field", fields).agg(F.first("p"))
    wide = wide.select(F.col("key").cast(kinds[key]).alias("_key"), *(F.col(f"`{f}`").alias(f"_p_{f}") for f in fields))

    def cell(f: str) -> Column:
        value = F.col(f"_p_{f}")["value"]
        typed = value.cast(kinds[f]) if isinstance(kinds[f], T.AtomicType) else F.from_json(value, kinds[f])
        return F.when(F.col(f"_p_{f}").isNotNull(), typed).otherwise(F.col(f)).alias(f)

    return rows.join(wide, F.col(key) == F.col("_key"), "left").select(*(F.col(f) if f == key else cell(f) for f in rows.columns))


def restore_marks(rows: DataFrame, key: str, field: str, values: DataFrame, mark: str) -> DataFrame:
    """Sets a field to the value of (key, value) where it lacks the mark; a row that has it, or isn't listed, stays."""
    listed = values.select(F.col("key").alias("_key"), F.col("value").alias("_value"))
    lacks = F.col("_key").isNotNull() & ~F.contains(F.coalesce(field, F.lit("")), F.lit(mark))
    return rows.join(listed, F.col(key) == F.col("_key"), "left").withColumn(field, F.when(lacks, F.col("_value")).otherwise(F.col(field))).drop("_key", "_value")


def same_targets(a: DataFrame, b: DataFrame, key: list[str]) -> None:
    """Fails unless both correction tables speak of the same cells."""
    for x, y in ((a, b), (b, a)):
        fail_if_any(x.join(y, key, "left_anti"), "a correction without its counterpart")


def backfill(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Adds columns that are missing, with their default; a null that is there stays null."""
    return rows.withColumns({c: v for c, v in defaults.items() if c not in rows.columns})


def flag_members(rows: DataFrame, key: str, members: DataFrame, flag: str) -> DataFrame:
    """Whether a row's key is in a set; a value that drifted is set right."""
    known = members.select(F.col(members.columns[0]).alias("_member")).distinct()
    return rows.drop(flag).join(known, F.col(key) == F.col("_member"), "left").withColumn(flag, F.col("_member").isNotNull()).drop("_member")


def rename_keys(rows: DataFrame, key: str, renames: DataFrame) -> DataFrame:
    """Renames keys by (old, new). Done already: no change. Both there, or neither: fails."""
    there = rows.select(F.col(key).alias("k")).distinct()
    old = renames.join(there.withColumnRenamed("k", "old").withColumn("has_old", F.lit(True)), "old", "left")
    state = old.join(there.withColumnRenamed("k", "new").withColumn("has_new", F.lit(True)), "new", "left")
    fail_if_any(state.filter("(has_old is null) = (has_new is null)"), "a rename whose old and new keys are both there, or both missing")
    table = renames.select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    return rows.join(table, F.col(key) == F.col("_old"), "left").withColumn(key, F.coalesce("_new", key)).drop("_old", "_new")


def rename_column(rows: DataFrame, old: str, new: str) -> DataFrame:
    """Renames a column, into one that may be there: equal or missing values join, others fail."""
    if old not in rows.columns:
        return rows
    if new not in rows.columns:
        return rows.withColumnRenamed(old, new)
    clash = F.col(old).isNotNull() & F.col(new).isNotNull() & (F.col(old) != F.col(new))
    fail = F.raise_error(F.lit(f"{old} and {new} differ in a row")).cast(rows.schema[new].dataType)
    return rows.withColumn(new, F.when(clash, fail).otherwise(F.coalesce(F.col(new), F.col(old)))).drop(old)


def migrate_values(rows: DataFrame, field: str, table: dict[str, str]) -> DataFrame:
    """Old words of a vocabulary become new ones; all others stay."""
    return rows.withColumn(field, F.coalesce(looked_up(field, table), F.col(field)))


def migrated(rows: DataFrame, field: str, key: str, table: dict[str, str]) -> DataFrame:
    """(old, new, n, first_key, last_key) of the values that a migration moves."""
    hit = rows.select(F.col(field).alias("old"), looked_up(field, table).alias("new"), F.col(key).alias("k")).filter("new is not null")
    return hit.groupBy("old", "new").agg(F.count("*").alias("n"), F.min("k").alias("first_key"), F.max("k").alias("last_key"))


def set_path(c: Column, path: list[str | int], value: Column) -> Column:
    """A nested value replaced; numbers are places in arrays, a missing place fails the query."""
    if not path:
        return value
    head, rest = path[0], path[1:]
    if isinstance(head, str):
        return c.withField(head, set_path(c[head], rest, value))
    changed = F.transform(c, lambda x, i: F.when(i == head, set_path(x, rest, value)).otherwise(x))
    return F.when(F.size(c) > head, changed).otherwise(F.raise_error(F.lit(f"no element {head}")))


def members_or_pattern(rows: DataFrame, key: str, members: DataFrame, text: str, pattern: str, flag: str) -> DataFrame:
    """Whether a row's key is in a set or its text is of the pattern."""
    return flag_members(rows, key, members, flag).withColumn(flag, F.col(flag) | F.coalesce(F.col(text).rlike(pattern), F.lit(False)))


def in_order(rows: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame]]], key: list[str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows after all named stages in their order, audit of the cells that each stage changed)."""
    changes = None
    for name, change in stages:
        after = change(rows)
        own = audit(rows, after, key, fields, name)
        rows, changes = after, own if changes is None else changes.unionByName(own)
    if changes is None:
        raise ValueError("no stages")
    return rows, changes


def scoped(rows: DataFrame, scope: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A change made to the rows in scope alone; rows of which the scope is unknown stay as they are."""
    inside = F.coalesce(scope, F.lit(False))
    return change(rows.filter(inside)).unionByName(rows.filter(~inside))


def first_set(rows: DataFrame, key: str, sets: list[tuple[str, DataFrame]], label: str, otherwise: str) -> DataFrame:
    """Adds the label of the first of several sets of keys that holds a row's key."""
    all_ = reduce(DataFrame.unionByName, (df.select(F.col(df.columns[0]).alias("_member"), F.lit(i).alias("_rank")) for i, (_, df) in enumerate(sets)))
    first = all_.groupBy("_member").agg(F.min("_rank").alias("_rank"))
    names = F.array(*(F.lit(name) for name, _ in sets))
    return rows.join(first, F.col(key) == F.col("_member"), "left").withColumn(label, F.coalesce(F.get(names, F.col("_rank")), F.lit(otherwise))).drop("_member", "_rank")


def derive(rows: DataFrame, derivers: list[tuple[str, Column]]) -> DataFrame:
    """Columns derived one after the other from a table of (name, expression)."""
    return reduce(lambda df, d: df.withColumn(*d), derivers, rows)


def apply_corrections(rows: DataFrame, corrections: DataFrame, key: str, name: str) -> DataFrame:
    """Right keys and names by (chunk, agent, wrong, right, right_name), each within its chunk only."""
    c = corrections.select(F.col("chunk").alias("_chunk"), F.col("agent").alias("_agent"), F.col("wrong").alias("_wrong"), F.col("right").alias("_right"), F.col("right_name").alias("_name"))
    on = (F.col("chunk") == F.col("_chunk")) & (F.col("agent") == F.col("_agent")) & (F.col(key) == F.col("_wrong"))
    return rows.join(c, on, "left").withColumns({key: F.coalesce("_right", key), name: F.coalesce("_name", name)}).drop("_chunk", "_agent", "_wrong", "_right", "_name")
