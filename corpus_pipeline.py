"""A training-data pipeline over documents: STAGES in order, each on all that the one before kept.

Stages return the columns of documents, but for the last, which returns each document's token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korpuswerk.llm import bpe, ctw, decontaminate, fitting, linededup, neardup, toxicity
from korpuswerk.llm.runtime import materialize

#: A document is toxic from this score on.
TOXIC = 0.3
#: Bytes that are encoded at once, and words that are remembered: by the last stage executors hold what others have left.
LEAN = 1 << 20, 25_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go. It learns from the labels of documents that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    seen = fitting.sample(docs, labels, "toxic", ~ctw.held_out(F.col("doc_id"), 4, 2), toxicity.MOST, toxicity.LONGEST)
    rest = tuple(c for c in docs.columns if c != "doc_id")
    return toxicity.score(docs, toxicity.train(seen), keep=rest).where(F.col("score") < TOXIC).select(docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier one repeats, or nearly so, are taken out of the texts."""
    return linededup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose five-word shingles have a Jaccard similarity of 0.8 or more to those of a kept one of lesser id."""
    return neardup.first_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurrence of a benchmark window go."""
    rest = tuple(c for c in docs.columns if c != "doc_id")
    found = decontaminate.overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=rest)
    return found.where(F.col("hit").isNull()).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of what they decode to."""
    vocabulary = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    both = bpe.encode(docs, *vocabulary, decoded=True, at_once=LEAN[0], remembered=LEAN[1])
    return both.select("doc_id", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level bpe", encode),
]

#: The network of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again. The last one's ids are given as a digest, as binary columns
    don't compare everywhere."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name.replace(' ', '-')}")
    return docs.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), "decoded_sha256")
