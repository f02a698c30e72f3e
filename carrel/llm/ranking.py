"""The first k rows of every group without sorting any: radix select.

A group's k-th largest value is found digit by digit: rows that agree with what is known of it are
counted by their next digit, in partial aggregates, and the digit in which the k-th row falls is
fixed, from the highest digit to the lowest. Rows of a larger value are in; rows of that value are
ties, among which the smallest items by UTF-8 bytes are taken in the same way, byte by byte. No
task holds a group, only a count for each digit of each group.

Cases: a group of fewer rows than k has all of them in; rows equal in value and item are all in if the
first of them is (their rank is then arbitrary among them); group columns hold no nulls, values are from
0 to 2**62; an empty table has no ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from carrel.sources.staging import stage

DIGIT = 8  #: bits that one round fixes


def _crossing(counts: Column, need: Column, ascending: bool) -> Column:
    """(digit, before): the digit of (digit, n) in ``counts`` at which n adds up to need, and the sum before it; null if it never does."""
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("int").alias("digit"), F.lit(None).cast("long").alias("before"))

    def step(now: Column, one: Column) -> Column:
        crossed = now["digit"].isNull() & (now["sum"] + one["n"] >= need)
        return F.struct((now["sum"] + one["n"]).alias("sum"), F.when(crossed, one["digit"]).otherwise(now["digit"]).alias("digit"), F.when(crossed, now["sum"]).otherwise(now["before"]).alias("before"))

    return F.aggregate(F.sort_array(counts, asc=ascending), start, step)


def _histogram(rows: DataFrame, keys: list[str], digit: Column, *more: str) -> DataFrame:
    """(keys, more, counts): counts has (digit, n) for each digit of a group; more: columns that are the same in a group."""
    counted = rows.groupBy(*keys, *more, digit.alias("digit")).agg(F.count("*").alias("n"))
    return counted.groupBy(*keys, *more).agg(F.collect_list(F.struct("digit", "n")).alias("counts"))


def thresholds(rows: DataFrame, keys: list[str], value: str, k: int) -> DataFrame:
    """(keys, _least, _need): the k-th largest value of each group and how many rows of just that value are wanted.

    Of a group with fewer rows than k, _least is -1.
    """
    top = rows.agg(F.max(value)).first()[0]
    state = stage(rows.select(*keys).distinct().select(*keys, F.lit(0).cast("long").alias("_least"), F.lit(k).cast("long").alias("_need")), "rank-state")
    shift = -(-max(1, int(top or 0).bit_length()) // DIGIT) * DIGIT
    while shift:
        shift -= DIGIT
        among = rows.join(state, keys).filter(F.shiftright(value, shift + DIGIT) == F.col("_least"))
        made = _histogram(among, keys, F.shiftright(value, shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int"), "_least", "_need")
        at = made.withColumn("at", _crossing(F.col("counts"), F.col("_need"), ascending=False))
        found = at.select(*keys, F.when(F.col("at.digit").isNull(), F.lit(-1)).otherwise(F.shiftleft("_least", DIGIT) + F.col("at.digit")).cast("long").alias("_least"), (F.col("_need") - F.coalesce("at.before", F.lit(0))).alias("_need"))
        found = found.unionByName(state.filter("_least < 0"))
        state = stage(found, "rank-state")
    return state


def _first_difference(low: Column, high: Column) -> Column:
    """The first byte, from 1, in which two different texts differ; behind the shorter if it begins the longer."""
    shorter = F.least(F.octet_length(low), F.octet_length(high))
    a, b = F.encode(low, "UTF-8"), F.encode(high, "UTF-8")
    differ = F.filter(F.sequence(F.lit(0), shorter), lambda i: (i > 0) & (F.substring(a, i, 1) != F.substring(b, i, 1)))
    return F.coalesce(F.try_element_at(differ, F.lit(1)), shorter + 1)


def _first_ties(ties: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Of rows with _need, those of each group that have the _need smallest items."""
    kept = []
    now = ties
    while True:
        groups = now.groupBy(*keys, "_need").agg(F.count("*").alias("_n"), F.min(item).alias("_low"), F.max(item).alias("_high"))
        groups = stage(groups.withColumn("_open", (F.col("_n") > F.col("_need")) & (F.col("_low") < F.col("_high"))), "rank-ties")
        kept.append(now.join(groups.filter("not _open").select(*keys), keys, "left_semi").select(*ties.columns))
        if groups.filter("_open").isEmpty():
            break
        place = groups.filter("_open").select(*keys, _first_difference(F.col("_low"), F.col("_high")).alias("_at"))
        byte = F.when(F.octet_length(item) < F.col("_at"), F.lit(-1)).otherwise(F.conv(F.hex(F.substring(F.encode(F.col(item), "UTF-8"), F.col("_at"), F.lit(1))), 16, 10).cast("int"))
        dealt = stage(now.join(place, keys).withColumn("_byte", byte), "rank-bytes")
        made = _histogram(dealt, keys, F.col("_byte"), "_need").withColumn("at", _crossing(F.col("counts"), F.col("_need"), ascending=True))
        cut = stage(made.select(*keys, F.col("at.digit").alias("_cut"), F.col("at.before").alias("_before")), "rank-cuts")
        sided = dealt.join(cut, keys)
        kept.append(sided.filter("_byte < _cut").select(*ties.columns))
        now = stage(sided.filter("_byte = _cut").withColumn("_need", F.col("_need") - F.col("_before")).select(*ties.columns), "rank-rest")
    out = kept[0]
    for one in kept[1:]:
        out = out.unionByName(one)
    return out


def first_ranks(rows: DataFrame, keys: list[str], value: str, item: str, k: int) -> DataFrame:
    """The rows (keys, value, item, rank) of rank 1 to k in their group: value descending, item by UTF-8 bytes ascending."""
    rows = stage(rows.select(*keys, value, item), "rank-rows")
    edges = thresholds(rows, keys, value, k)
    judged = rows.join(edges, keys).filter(F.col(value) >= F.col("_least"))
    ties = stage(judged.filter(F.col(value) == F.col("_least")), "rank-ties")
    found = judged.filter(F.col(value) > F.col("_least")).select(*keys, value, item).unionByName(_first_ties(ties, keys, item).select(*keys, value, item))
    order = W.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(item))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
