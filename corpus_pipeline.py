"""The corpus pipeline: classify, deduplicate, decontaminate, mix, tokenise.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner writes it as Parquet
and gives it, read again, to the next stage. All but the last keep the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carrel.llm import decontaminate, mixing, nearcopies, quality, tokenize
from carrel.llm.queries import TOKENIZER
from carrel.sources.staging import stage


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    A null, empty or wordless text gets the share of good labels and stays where that reaches the threshold; very long texts
    are judged whole; equal texts, repeated rows and ties score alike and share their fate; nulls in other columns
    change nothing; an empty table, or one without labels, loses nothing; clashing columns pass through.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: ball hashing, then five-word shingles at a similarity of 0.8.

    Null, empty and wordless texts are one group; a text of under five words is one shingle; of a group the row of the
    smallest doc_id stays, a null one last, of rows alike in doc_id and text any one; texts of any length count whole; an
    empty table stays empty; columns are those of the input, whatever their names.
    """
    return nearcopies.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked.

    A null or wordless item, or text, leaks nowhere; an item of under five words is one shingle of its size; rows of one
    doc_id are judged by themselves, equal rows alike; long texts count whole; an empty table of either kind loses nothing.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their sources takes them.

    A null source is a source, the last; null, empty and wordless texts have no words and aren't taken; equal rows are taken in the
    same order in every run; a document that the fraction cuts is kept up to that word; an empty table stays empty.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files; returns what is read back from them.

    A null or empty text has the end id alone; a null doc_id comes first; repeated rows are encoded each; an empty table has no file.
    """
    return tokenize.read_tokens(tokenize.write_tokens(docs, TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", classify),
    ("simhash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mix),
    ("token ids", tokens),
]

#: The classifier and the fingerprints can't be told in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to documents; the rows of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
