"""The registered queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, ctw, decontaminate, fitting, linededup, pii, quality, simhash, toxicity, urls


#: The rules of op9: verdict, host, path.
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in occurrences of benchmark windows."""
    return decontaminate.report(decontaminate.overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability by a model of the documents that are not held out."""
    return ctw.score(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    seen = fitting.sample(docs, labels, "toxic", ~ctw.held_out(F.col("doc_id"), 4, 2), toxicity.MOST, toxicity.LONGEST)
    return _predicted(toxicity.score(docs, toxicity.train(seen)), 4, 2)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels that are not held out."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    seen = fitting.sample(docs, labels, "quality", ~ctw.held_out(F.col("doc_id"), 5, 0), quality.MOST, quality.LONGEST, more=("n_chars",))
    return _predicted(quality.score(docs, quality.train(seen)), 5, 0)


def _predicted(scored: DataFrame, mod: int, rest: int) -> DataFrame:
    return scored.select("doc_id", ctw.held_out(F.col("doc_id"), mod, rest).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose id is divisible by 20."""
    return ann.search(_table(spark, sf_dir, "embeddings"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's dropped lines and what stays."""
    return linededup.report(_table(spark, sf_dir, "documents"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's spans of personal data."""
    return pii.report(pii.spans(_table(spark, sf_dir, "documents")))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict. A page's outcome is bad if the label of its number says low quality or toxic."""
    outcomes = _table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    judged = urls.judge(_table(spark, sf_dir, "pages"), outcomes, URL_RULES, outcome_key="doc_id")
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and the decoded bytes, as digests."""
    docs = _table(spark, sf_dir, "documents")
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = bpe.encode(docs, *vocabulary, decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_benchmark_decontamination, op2_lm_scoring, op3_toxicity, op4_quality_classifier, op5_nearest_neighbours, op6_line_dedup, op7_simhash_near_dedup, op8_pii, op9_url_filters, op10_byte_level_bpe)}


def llm_oracle_sql() -> dict[str, str]:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return {"op1_benchmark_decontamination": decontaminate.ORACLE, "op5_nearest_neighbours": ann.ORACLE, "op6_line_dedup": linededup.ORACLE, "op7_simhash_near_dedup": simhash.ORACLE, "op8_pii": pii.ORACLE, "op9_url_filters": urls.ORACLE.format(rules=rules), "op10_byte_level_bpe": bpe.oracle(public_tokenizers.path("byte_bpe_50k.tiktoken"))}
