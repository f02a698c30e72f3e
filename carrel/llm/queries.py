"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm import bpe, decontaminate, divergence, language_model, mixing, quality, rules, simhash, sql, substring, tokenize, toxicity, warc, whitening

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents: fingerprints of at most two differing bits link."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through the index."""
    index = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(index, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents by the marginals of a conditional random field."""
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.FLAG).cast("int").alias("predicted"), "spans")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of documents, written as directly addressable codes and read back."""
    return tokenize.read_tokens(tokenize.write_tokens(_table(spark, sf_dir, "documents"), TOKENIZER))


def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of documents with the verdicts of the base and the strict policy."""
    book = rules.apply(rules.stored(_table(spark, sf_dir, "documents")), "strict-1")
    base = rules.mask(rules.POLICIES["base-1"])
    failed = F.col("failed").bitwiseAND(F.lit(base)) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept", "failed")


def rules_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents each rule of the strict policy fails, and how many it fails alone."""
    return rules.ablation(rules.stored(_table(spark, sf_dir, "documents")), "strict-1")


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of documents by a gated recurrent language model and by unigrams."""
    docs = _table(spark, sf_dir, "documents")
    found = language_model.score(docs, *language_model.fit(docs))
    return found.withColumn("held_out", language_model.held_out(F.col("doc_id")))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of smaller doc_id holds."""
    found = substring.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of documents by nearest-neighbour votes."""
    docs = _table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= quality.KEEP).cast("int").alias("predicted"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each benchmark item leaked into it."""
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on the first components of their covariance, with unit variance."""
    vectors = whitening.integers(_table(spark, sf_dir, "embeddings"))
    return whitening.whitened(vectors, whitening.fit(vectors))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the terms of each source differ from those of the other sources and of its language."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded by byte-level BPE and decoded again."""
    found = bpe.encode(_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, with_text=True)
    n_tokens = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return found.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_simhash, op2_warc, op3_toxicity, op4_tokens, op5_rules, rules_ablation, op6_language_model, op7_substrings, op8_quality, op9_decontaminate, op10_mix, op11_whitening, op12_divergence, op13_bpe]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": sql.OP2, "op5_rules": sql.OP5, "rules_ablation": sql.ABLATION, "op7_substrings": sql.OP7, "op9_decontaminate": sql.OP9, "op10_mix": sql.OP10, "op12_divergence": sql.OP12}
