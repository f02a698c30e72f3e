"""Quality rules as a ledger of failure bits. DataFrame functions only.

``ledger`` measures every text once and evaluates every rule once: bit i of ``failed`` is set where
rule i fails. ``stored`` writes it, so that all that follows reads a few numbers a row. A policy is a named, versioned mask of rules; applying one, or comparing policies and
leaving rules out, is bitwise arithmetic on the ledger and never reads a text again.

Cases: a null or wordless text measures zero everywhere and fails ``few_words``; repeated rows give
repeated result rows; null ids stay; an empty table gives an empty ledger; further columns are
ignored. Windows within one text are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.sources.staging import stage

WORD = "[^\\x20\\x09-\\x0D]+"
WINDOW = 8

#: name -> condition over the measurements; the position is the bit. Only ever append.
RULES: dict[str, Column | str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 25 * n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "echoed_words": "100 * n_echoes > 30 * n_words",
    "capitals": "100 * n_capitals > 60 * word_chars",
    "short_words": "10 * word_chars < 15 * n_words",
    "long_words": "word_chars > 30 * n_words",
}

#: Policies by version: the rules that a document must not fail.
POLICIES: dict[str, list[str]] = {
    "base-1": ["few_words", "repeated_windows"],
    "strict-1": list(RULES),
}


def mask(names: list[str]) -> int:
    order = list(RULES)
    return sum(1 << order.index(name) for name in names)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id with the measurements of each text."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    split = text.select(
        "doc_id",
        F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace("_text", "[\\x20\\x09-\\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
    )
    n = F.size("_words")
    grams = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("_words", i, F.lit(WINDOW))))).otherwise(F.array().cast("array<bigint>"))
    echoes = F.size(F.filter(F.zip_with("_words", F.slice("_words", F.lit(2), n), lambda a, b: a == b), lambda same: same))
    counted = split.select(
        "doc_id", "word_chars", "n_symbols", "n_capitals",
        n.cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        echoes.cast("long").alias("n_echoes"), grams.alias("_grams"),
    )
    some = F.size(F.array_distinct("_grams")) < F.size("_grams")
    placed = F.when(some, F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))))
    ordered = counted.withColumn("_placed", placed).drop("_grams")
    pairs = F.zip_with("_placed", F.slice("_placed", F.lit(2), F.size("_placed")), lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    starts = F.when(F.col("_placed").isNotNull(), F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
    started = ordered.withColumn("_starts", starts).drop("_placed")
    gaps = F.zip_with("_starts", F.slice("_starts", F.lit(2), F.size("_starts")), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.coalesce(F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap), F.lit(0))
    return started.withColumn("n_repeat_words", covered.cast("long")).drop("_starts")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: the bits of the rules that fail."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return measure(docs).withColumn("failed", bits)


def stored(docs: DataFrame) -> DataFrame:
    """The ledger of ``docs``, written to the shared folder and read from there."""
    return stage(ledger(docs), "ledger")


def apply(book: DataFrame, policy: str, column: str = "kept") -> DataFrame:
    """Adds whether each row of a ledger passes a policy."""
    return book.withColumn(column, F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablation(book: DataFrame, policy: str) -> DataFrame:
    """(rule, n_failed, n_only) for each rule of a policy.

    n_only counts the rows that the policy would keep if it did without the rule. The ledger is
    summed by its distinct bit patterns first, so the rules are dealt over these few rows alone.
    """
    names = POLICIES[policy]
    full = mask(names)
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(full)).alias("failed")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(mask([name])).cast("long").alias("bit")) for name in names))
    dealt = patterns.select("failed", "n", F.explode(rules).alias("r")).select("failed", "n", "r.*")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    return dealt.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(F.col("failed") == F.col("bit"), F.col("n"))), F.lit(0)).alias("n_only"),
    )
