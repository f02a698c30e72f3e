"""Proof queries of the consensus merge: line items of an order are its agents' versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.operators import consensus as c
from carrel.plans.registry import Book
from carrel.sources.staging import load, tasks_for

book = Book()

#: Each line number is an agent, and says what an order's flag and status are.
_ROWS = "rows AS (SELECT l_orderkey AS key, l_linenumber AS agent, min(l_returnflag) AS flag, min(l_linestatus) AS status FROM lineitem GROUP BY 1, 2)"
_LONG = "long AS (SELECT key, agent, 'flag' AS field, flag AS value FROM rows UNION ALL SELECT key, agent, 'status', status FROM rows)"
_COUNTED = "counted AS (SELECT key, field, value, count(*) AS n, min(agent) AS first FROM long GROUP BY 1, 2, 3)"
_RANKED = "ranked AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY key, field, n) > 1 AS tied, sum(n) OVER (PARTITION BY key, field) AS present FROM counted WINDOW w AS (PARTITION BY key, field ORDER BY n DESC, first))"
_CHOSEN = f"WITH {_ROWS}, {_LONG}, {_COUNTED}, {_RANKED}, chosen AS (SELECT key, field, value, n, present, tied FROM ranked WHERE place = 1)"


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order has a few line items, so all of a key goes to one of as many tasks as the rows need, and later counts move nothing."""
    li = load(spark, sf_dir, "lineitem")
    dealt = li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("agent"), "l_returnflag", "l_linestatus").repartition(tasks_for(li), "key")
    return dealt.groupBy("key", "agent").agg(F.min("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status"))


def _said(name: str = "value"):
    return F.get_json_object(name, "$.v").alias("value")


@book.query(f"{_CHOSEN} SELECT key, field, value, CAST(n AS BIGINT) AS n, CAST(present AS BIGINT) AS present, tied FROM chosen")
def vote_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent value of each field; of tied ones that of the first agent, and marked."""
    cast = c.votes(_rows(spark, sf_dir), ["key"], "agent", ["flag", "status"], c.Rules(), shown=False)
    chosen = c.decide(c.tally(cast, ["key"]), ["key"])
    return chosen.select("key", "field", _said(), "n", "present", "tied")


@book.query(f"WITH {_ROWS} SELECT key, count(DISTINCT agent) AS agents FROM rows GROUP BY key HAVING count(DISTINCT agent) < 2")
def vote_uncorroborated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.uncorroborated(_rows(spark, sf_dir), ["key"], "agent")


@book.query(f"""
{_CHOSEN}, corroborated AS (SELECT key FROM rows GROUP BY key HAVING count(DISTINCT agent) >= 2)
SELECT key, max(CASE WHEN field = 'flag' THEN CASE WHEN tied THEN o_orderstatus ELSE value END END) AS flag, max(CASE WHEN field = 'status' THEN CASE WHEN tied THEN o_orderstatus ELSE value END END) AS status,
  CAST(max(CASE WHEN field = 'flag' THEN n END) AS BIGINT) AS n_flag, CAST(max(CASE WHEN field = 'status' THEN n END) AS BIGINT) AS n_status
FROM chosen JOIN corroborated USING (key) JOIN orders ON o_orderkey = key GROUP BY key""")
def vote_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole merge; ties go to an override, here the order's status."""
    rows = _rows(spark, sf_dir)
    tasks = tasks_for(load(spark, sf_dir, "lineitem"))
    enough = rows.groupBy("key").agg(F.min("agent").alias("_first"), F.max("agent").alias("_last")).filter("_first < _last").select("key")
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), "o_orderstatus").repartition(tasks, "key")
    overrides = o.select("key", F.explode(F.array(F.lit("flag"), F.lit("status"))).alias("field"), F.concat(F.lit('"'), "o_orderstatus", F.lit('"')).alias("value"))
    return c.merge(rows.join(enough, "key", "left_semi"), "key", "agent", ["flag", "status"], c.Rules(), overrides)


@book.query(f"""
WITH {_ROWS}, long AS (SELECT key, agent, CASE WHEN flag = 'R' THEN NULL ELSE flag END AS value FROM rows),
counted AS (SELECT key, value, count(*) AS n, min(agent) AS first FROM long GROUP BY 1, 2)
SELECT key, value, n FROM counted QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, first) = 1""")
def vote_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null sentinels vote as null; here the flag R stands for one."""
    cast = c.votes(_rows(spark, sf_dir), ["key"], "agent", ["flag"], c.Rules(sentinels=["r"], first_wins=True))
    return c.decide(c.tally(cast, ["key"]), ["key"]).select("key", _said(), "n")


@book.query(f"""
{_CHOSEN} SELECT c.key, c.field, CAST(c.n AS BIGINT) AS n, CAST(c.present AS BIGINT) AS present, c.value AS chosen, string_agg(l.agent || '=' || l.value, ' ' ORDER BY l.agent) AS said
FROM chosen c JOIN long l USING (key, field) WHERE c.n < c.present GROUP BY ALL""")
def vote_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = tasks_for(load(spark, sf_dir, "lineitem"))
    cast = c.votes(_rows(spark, sf_dir), ["key"], "agent", ["flag", "status"], c.Rules()).repartition(tasks, "key", "field")
    found = c.disagreements(cast, c.decide(c.tally(cast, ["key"]), ["key"]), ["key"])
    said = F.array_join(F.transform("said", lambda x: F.concat(x["agent"].cast("string"), F.lit("="), F.get_json_object(x["shown"], "$.v"))), " ")
    return found.select("key", "field", "n", "present", F.get_json_object("chosen", "$.v").alias("chosen"), said.alias("said"))


@book.query(f"""
WITH {_ROWS} SELECT key, CASE WHEN count(DISTINCT CASE WHEN key % 5 = 0 THEN agent % 2 ELSE 0 END) > 1 THEN 'STRUCTURE' WHEN count(DISTINCT flag) > 1 THEN 'IDENTIFIER' ELSE 'PROSE' END AS kind,
  CASE WHEN count(DISTINCT CASE WHEN key % 5 = 0 THEN agent % 2 ELSE 0 END) > 1 OR count(DISTINCT flag) > 1 THEN NULL ELSE
    array_to_string(list_distinct_in_order, '|') END AS cited
FROM (SELECT *, (SELECT list(s ORDER BY a) FROM (SELECT status AS s, min(agent) AS a FROM rows r2 WHERE r2.key = rows.key GROUP BY status)) AS list_distinct_in_order FROM rows) GROUP BY key, list_distinct_in_order""")
def tie_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What versions of a list of names differ in, and citations united where only prose differs."""
    name = F.struct(F.col("flag").alias("anglicised"), F.lit(None).cast("string").alias("transliteration"), F.array("status").alias("attested_in"))
    double = (F.col("key") % 5 == 0) & (F.col("agent") % 2 == 1)
    rows = _rows(spark, sf_dir).select("key", "agent", F.when(double, F.array(name, name)).otherwise(F.array(name)).alias("names"))
    lists = rows.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("agent", "names"))).alias("all"))
    values = F.transform("all", lambda x: x["names"])
    kind = c.classify_tie(values, ["anglicised", "transliteration"])
    cited = F.array_join(F.get(c.settle_prose(values), F.lit(0))["attested_in"], "|")
    return lists.select("key", kind.alias("kind"), F.when(kind == "PROSE", cited).alias("cited"))


@book.query("SELECT user_id, 2 * count(*) FILTER (event_type = 'error' OR value > 50) > count(*) AS flag FROM events GROUP BY 1")
def majority_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("user_id", ((F.col("event_type") == "error") | (F.col("value") > 50)).alias("flag"))
    return c.majority_flag(e, ["user_id"], "flag")


@book.query("""
WITH e AS (SELECT event_id AS key, event_type, regexp_extract(props, '([0-9]+)', 1) AS k FROM events)
SELECT key, 'kind' AS field, '"' || event_type || '"' AS value, 2 AS n, 3 AS present, false AS tied FROM e
UNION ALL SELECT key, 'k', k, CASE WHEN key % 3 = 0 THEN 2 ELSE 3 END, 3, false FROM e
UNION ALL SELECT key, 'note', 'null', 3, 3, false FROM e""")
def vote_raw_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes over raw JSON: three agents with other fields, orders of names and spellings of numbers."""
    k = F.regexp_extract("props", "([0-9]+)", 1)
    kind = F.concat(F.lit('"kind": "'), "event_type", F.lit('"'))
    said = {
        "a": F.concat(F.lit("{"), kind, F.lit(', "k": '), k, F.lit("}")),
        "b": F.concat(F.lit('{"k":'), k, F.when(F.col("event_id") % 3 == 0, ".0").otherwise(""), F.lit(","), kind, F.lit("}")),
        "c": F.concat(F.lit('{"k": '), k, F.lit(', "note": " N/A "}')),
    }
    agents = F.explode(F.array(*(F.struct(F.lit(name).alias("agent"), text.alias("data")) for name, text in said.items()))).alias("v")
    rows = load(spark, sf_dir, "events").select(F.col("event_id").alias("key"), agents).select("key", "v.*")
    return c.decide(c.tally(c.raw_votes(rows, ["key"], "agent", "data"), ["key"]), ["key"])
