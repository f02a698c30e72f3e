"""Majority vote over several agents' versions of the same rows.

Rows are turned into votes (key, agent, field, value), value being JSON text. Counting is two
aggregates that combine before the shuffle, so neither an agent with many rows nor a key that holds
a third of all rows lands in one task. Overrides are joined; Catalyst broadcasts them while they are
small by its own threshold.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carrel.functions.text import strip
from carrel.operators.guards import DataError, fail_if_any

#: Texts that mean nothing was found.
SENTINELS = ["none", "-", "—", "n/a", "na", "unknown", "null"]
#: Fields of a name entry that tell names apart.
IDENTIFYING = ["anglicised", "transliteration", "translation", "variant_index", "is_variant"]


#: Letters of the ASCII spelling of transliterations, and code points that stand for others.
SPELLINGS = {"A": "ꜣ", "a": "ꜥ", "H": "ḥ", "x": "ḫ", "X": "ẖ", "S": "š", "T": "ṯ", "D": "ḏ", "q": "ḳ", "ɜ": "ꜣ", "ɛ": "ꜥ", "ˁ": "ꜥ"}


def canonical_names(names: Column, field: str = "transliteration", spellings: dict[str, str] = SPELLINGS) -> Column:
    """A list of name structs with one field in one spelling, so that versions that differ in it agree in the vote."""
    return F.transform(names, lambda e: e.withField(field, F.translate(e[field], "".join(spellings), "".join(spellings.values()))))


def require_agents(rows: DataFrame, agent: str, expected: list) -> None:
    """Fails if one of the agents has no row at all."""
    there = {r[0] for r in rows.filter(F.col(agent).isin(expected)).select(agent).distinct().collect()}  # no more than are expected
    missing = [a for a in expected if a not in there]
    if missing:
        raise DataError(f"agents without rows: {missing}")


def together(versions: dict[str, DataFrame], agent: str = "agent") -> DataFrame:
    """The agents' versions as one table with every field that any of them has; a field that one lacks is null there."""
    each = [df.withColumn(agent, F.lit(name)) for name, df in versions.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)


@dataclass(frozen=True)
class Rules:
    """How a source's versions are merged."""

    sentinels: list[str] = field(default_factory=lambda: list(SENTINELS))
    deep: bool = True  #: sentinels inside lists and structs count too
    first_wins: bool = False  #: a tie goes to the first agent instead of failing
    prose_fields: list[str] = field(default_factory=list)  #: name lists whose prose ties are settled
    least_agents: int = 2


def without_sentinels(c: Column, kind: T.DataType, sentinels: list[str], deep: bool = True) -> Column:
    """Null for texts that mean nothing; with ``deep`` at every depth of lists and structs."""
    if isinstance(kind, T.StringType):
        return F.when(~F.coalesce(F.lower(strip(c)).isin(sentinels), F.lit(False)), c)
    if deep and isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: without_sentinels(x, kind.elementType, sentinels))
    if deep and isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(without_sentinels(c[f.name], f.dataType, sentinels).alias(f.name) for f in kind)))
    return c


def cell(c: Column) -> Column:
    """Any value as JSON text, nulls kept; equal values give equal texts."""
    return F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})


def votes(rows: DataFrame, key: list[str], agent: str, fields: list[str], rules: Rules, shown: bool = True) -> DataFrame:
    """(key..., agent, field, value, shown): value after, shown before sentinels became null."""
    kinds = {f.name: f.dataType for f in rows.schema}
    said = lambda f: [cell(F.col(f)).alias("shown")] if shown else []
    cells = F.array(*(F.struct(F.lit(f).alias("field"), cell(without_sentinels(F.col(f), kinds[f], rules.sentinels, rules.deep)).alias("value"), *said(f)) for f in fields))
    return rows.select(*key, F.col(agent).alias("agent"), F.explode(cells).alias("c")).select(*key, "agent", "c.*")


def _normal(value: object, sentinels: frozenset[str], deep: bool) -> object:
    """Null for texts that mean nothing, at every depth if ``deep``."""
    if isinstance(value, str):
        return None if value.strip().lower() in sentinels else value
    if deep and isinstance(value, list):
        return [_normal(v, sentinels, True) for v in value]
    if deep and isinstance(value, dict):
        return {k: _normal(v, sentinels, True) for k, v in value.items()}
    return value


def raw_cells(data: Column, rules: Rules) -> Column:
    """Map of each field of a JSON object to its value in one canonical text, sentinels null.

    Names are in order at all depths, numbers stay as they are written (1 and 1.0 differ), and letters aren't escaped, so
    equal texts are equal values. A text that is no JSON object fails.
    """
    sentinels, deep = frozenset(rules.sentinels), rules.deep

    @F.pandas_udf("map<string,string>")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else {k: json.dumps(_normal(v, sentinels, deep), ensure_ascii=False, sort_keys=True) for k, v in json.loads(t).items()})

    return read(data)


def raw_votes(rows: DataFrame, key: list[str], agent: str, data: str, rules: Rules = Rules()) -> DataFrame:
    """(key..., agent, field, value) over rows of raw JSON whose fields differ.

    A key's fields are all that one of its agents has; an agent without one votes null there. ``tally`` and ``decide`` go on from here.
    """
    read = rows.select(*key, F.col(agent).alias("agent"), raw_cells(F.col(data), rules).alias("cells"))
    fields = read.select(*key, F.explode(F.map_keys("cells")).alias("field")).distinct()
    return read.join(fields, key).select(*key, "agent", "field", F.coalesce(F.try_element_at("cells", F.col("field")), F.lit("null")).alias("value"))


def tally(cast: DataFrame, key: list[str]) -> DataFrame:
    """(key..., field, value, n, first): how many agents said a value, and the first that did."""
    return cast.groupBy(*key, "field", "value").agg(F.count("*").alias("n"), F.min("agent").alias("first"))


def decide(counted: DataFrame, key: list[str]) -> DataFrame:
    """(key..., field, value, n, present, tied): the most frequent value, of tied ones the first agent's."""
    # of the most frequent values, the one of the first agent and of the last one: they are the same if it is alone
    low, high = F.min(F.struct((-F.col("n")).alias("n"), "first", "value")), F.max(F.struct("n", "first", "value"))
    best = counted.groupBy(*key, "field").agg(low.alias("_low"), high.alias("_high"), F.sum("n").alias("present"))
    tied = ~(F.col("_low.first").eqNullSafe(F.col("_high.first")) & F.col("_low.value").eqNullSafe(F.col("_high.value")))
    return best.select(*key, "field", F.col("_low.value").alias("value"), F.col("_high.n").alias("n"), "present", tied.alias("tied"))


def uncorroborated(rows: DataFrame, key: list[str], agent: str, least: int = 2) -> DataFrame:
    """Keys that fewer agents than needed have."""
    return rows.groupBy(*key).agg(F.count_distinct(agent).alias("agents")).filter(F.col("agents") < least)


def classify_tie(values: Column, identifying: list[str] = IDENTIFYING) -> Column:
    """What tied versions of a list of name structs differ in: STRUCTURE, IDENTIFIER or PROSE.

    values: array of the agents' arrays. STRUCTURE: a null list or different lengths; IDENTIFIER: a
    field that tells names apart; PROSE: anything else.
    """
    sizes = F.transform(values, lambda v: F.coalesce(F.size(v), F.lit(-1)))
    names = F.transform(values, lambda v: F.transform(v, lambda e: F.to_json(F.struct(*(e[f].alias(f) for f in identifying)), {"ignoreNullFields": "false"})))
    structure = (F.size(F.array_distinct(sizes)) > 1) | (F.array_min(sizes) < 0)
    return F.when(structure, "STRUCTURE").when(F.size(F.array_distinct(names)) > 1, "IDENTIFIER").otherwise("PROSE")


def tie_class(values: Column, kind: T.DataType, identifying: list[str] = IDENTIFYING) -> Column:
    """SCALAR for a field that is no list of name structs, else what its tied versions differ in."""
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
        return classify_tie(values, [f for f in identifying if f in kind.elementType.names])
    return F.lit("SCALAR")


def settle_prose(values: Column, additive: str = "attested_in") -> Column:
    """The version with the shortest JSON (then the first by its letters), its citations united.

    values: array of the agents' arrays of name structs, first agent first. At each position the
    additive field is the union over agents, each once, in the order first seen.
    """
    def text(v: Column) -> Column:
        return F.to_json(F.struct(v.alias("v")), {"ignoreNullFields": "false"})

    base = F.get(F.array_sort(F.transform(values, lambda v: F.struct(F.length(text(v)).alias("n"), text(v).alias("t"), v.alias("v")))), F.lit(0))["v"]
    united = lambda i: F.array_distinct(F.flatten(F.filter(F.transform(values, lambda v: F.get(v, i)[additive]), lambda x: x.isNotNull())))
    return F.transform(base, lambda e, i: e.withField(additive, united(i)))


def check_overrides(overrides: DataFrame) -> DataFrame:
    """(key, field, value) from (target ``key|field``, value, rationale); a malformed entry fails."""
    parts = F.split("target", r"\|", 2)
    read = overrides.select(F.get(parts, F.lit(0)).alias("key"), F.get(parts, F.lit(1)).alias("field"), "value", "rationale", "target")
    bad = read.filter("field is null or trim(key) = '' or trim(field) = '' or rationale is null or trim(rationale) = ''")
    fail_if_any(bad, "a malformed override")
    fail_if_any(read.groupBy("key", "field").count().filter("count > 1"), "an override stands twice")
    return read.select("key", "field", "value")


def merge(rows: DataFrame, key: str, agent: str, fields: list[str], rules: Rules = Rules(), overrides: DataFrame | None = None, agents: list | None = None) -> DataFrame:
    """(key, fields..., one column n_<field> each): one row for each key.

    overrides: (key, field, value as JSON text) for ties. A key that too few agents have fails the
    merge, as does a tie without an override, unless the rules settle it, and an agent of ``agents``
    without any row.
    """
    if agents is not None:
        require_agents(rows, agent, agents)
    fail_if_any(uncorroborated(rows, [key], agent, rules.least_agents), "too few agents have a key")
    kinds = {f.name: f.dataType for f in rows.schema}
    # both sides become one row a key before they meet: half as many rows or fewer, in the partitions that the votes are in by then
    chosen = decide(tally(votes(rows, [key], agent, fields, rules, shown=False), [key]), [key])
    wide = chosen.select(key, "field", F.struct("value", "n", "tied").alias("cell")).groupBy(key).pivot("field", fields).agg(F.first("cell"))
    wide = wide.select(key, F.struct(*fields).alias("_cells"))
    if overrides is not None:
        own = overrides.select(F.col("key").cast(kinds[key]).alias(key), "field", F.concat(F.lit('{"v":'), "value", F.lit("}")).alias("override"))
        told = own.groupBy(key).pivot("field", fields).agg(F.min("override"))
        wide = wide.join(told.select(key, F.struct(*fields).alias("_overrides")), key, "left")
    else:
        wide = wide.withColumn("_overrides", F.lit(None).cast(T.StructType([T.StructField(f, T.StringType()) for f in fields])))
    cells = {f: (F.col("_cells")[f], F.col("_overrides")[f]) for f in fields}

    def value(f: str) -> Column:
        cell, override = cells[f]
        fail = F.raise_error(F.concat(F.lit("a tie without an override: "), F.col(key).cast("string"), F.lit(f"|{f}"))).cast("string")
        tied = cell["tied"] & F.lit(not rules.first_wins and f not in rules.prose_fields)
        chosen = F.when(cell["tied"] & override.isNotNull(), override).when(tied, fail).otherwise(cell["value"])
        return F.from_json(chosen, T.StructType([T.StructField("v", kinds[f])]))["v"]

    out = wide.select(key, *(value(f).alias(f) for f in fields), *(cells[f][0]["n"].alias(f"n_{f}") for f in fields))
    if not rules.prose_fields:
        return out
    open_ties = {f: wide.filter(cells[f][0]["tied"] & cells[f][1].isNull()).select(key) for f in rules.prose_fields}
    return _with_prose(out, rows, key, agent, open_ties, rules)


def _with_prose(out: DataFrame, rows: DataFrame, key: str, agent: str, open_ties: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """Ties of name lists without an override: prose ties are settled, others fail."""
    for f in rules.prose_fields:
        kind = rows.schema[f].dataType
        mine = rows.join(open_ties[f], key, "left_semi")
        lists = mine.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(agent).alias("a"), without_sentinels(F.col(f), kind, rules.sentinels, rules.deep).alias("v")))).alias("all"))
        values = F.transform("all", lambda x: x["v"])
        what = classify_tie(values)
        fail = F.raise_error(F.concat(F.lit(f"a tie of {f} without an override ("), what, F.lit("): "), F.col(key).cast("string"))).cast(kind)
        settled = lists.select(F.col(key).alias("_key"), F.when(what == "PROSE", settle_prose(values)).otherwise(fail).alias("_settled"))
        out = out.join(settled, F.col(key) == F.col("_key"), "left").withColumn(f, F.when(F.col("_key").isNotNull(), F.col("_settled")).otherwise(F.col(f))).drop("_key", "_settled")
    return out


def disagreements(cast: DataFrame, chosen: DataFrame, key: list[str]) -> DataFrame:
    """(key..., field, n, present, said, chosen): fields not all agents agree in, and who said what."""
    open_ = chosen.filter(F.col("n") < F.col("present"))
    # the few texts of a field are kept where they aren't all alike, without asking for the open fields first
    said = cast.groupBy(*key, "field").agg(F.array_sort(F.collect_list(F.struct("agent", "shown"))).alias("said"), F.min("value").alias("_low"), F.max("value").alias("_high")).filter("_low <> _high")
    return open_.join(said, [*key, "field"]).select(*key, "field", "n", "present", "said", F.col("value").alias("chosen"))


def majority_flag(rows: DataFrame, key: list[str], flag: str) -> DataFrame:
    """Whether more than half of a key's rows have the flag; null counts as not."""
    return rows.groupBy(*key).agg((2 * F.sum(F.coalesce(F.col(flag), F.lit(False)).cast("int")) > F.count("*")).alias(flag))
