"""Author-disjoint splits of documents into train, validation and test."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from korpuswerk.functions import text as X

SEED = 42
#: Authors that the driver permutes at most; a corpus has far fewer of them than documents.
MOST_AUTHORS = 5_000_000
SPLITS = ("train", "validation", "test")


def documents(records: DataFrame, year_start: int | None = None, year_end: int | None = None) -> DataFrame:
    """(basename, date, decade, genre, author) of each document, from its first record, within the years (inclusive)."""
    first = records.where(F.col("date").isNotNull()) if "date" in records.columns else records
    if "par_idx" in records.columns:
        first = first.groupBy("basename").agg(F.min_by(F.struct("date", "genre", "author"), "par_idx").alias("r")).select("basename", "r.*")
    if year_start is not None:
        first = first.where(F.col("date") >= year_start)
    if year_end is not None:
        first = first.where(F.col("date") <= year_end)
    return first.select("basename", "date", X.decade(F.col("date")).alias("decade"), X.coarse_genre(F.col("genre")).alias("genre"), "author")


def groups(docs: DataFrame) -> DataFrame:
    """(decade, genre, n_docs): the groups of documents."""
    return docs.groupBy("decade", "genre").agg(F.count("*").alias("n_docs"))


def author_counts(docs: DataFrame) -> DataFrame:
    """(author, works, first): in how many groups an author has documents, and where the author first comes in the order of
    groups (by their first document's name) and names."""
    g = docs.groupBy("decade", "genre").agg(F.min("basename").alias("at"))
    own = docs.select("decade", "genre", "author").distinct().join(g, ["decade", "genre"])
    return own.groupBy("author").agg(F.count("*").alias("works"), F.min(F.struct("at", "author")).alias("first"))


def _halves(n: int, test: float) -> tuple[np.ndarray, np.ndarray]:
    """Kept and held-out places of n, by a seeded permutation; the held-out share is rounded up."""
    out = math.ceil(test * n)
    order = np.random.RandomState(SEED).permutation(n)
    return order[out:], order[:out]


def split_authors(authors: list[str], size_test: float = 0.1) -> dict[str, str]:
    """Author to split: a share of size_test each for validation and test, the rest for training."""
    if not authors:
        return {}
    train, held = _halves(len(authors), 2 * size_test)
    validation, test = _halves(len(held), 0.5) if len(held) > 1 else (np.arange(0), np.arange(len(held)))
    out = {authors[i]: "train" for i in train}
    return out | {authors[held[i]]: "validation" for i in validation} | {authors[held[i]]: "test" for i in test}


def split(docs: DataFrame, size_test: float = 0.1) -> DataFrame:
    """docs with split: all documents of an author are in one. Documents without an author are tests.

    The list of authors is gathered, as one seeded permutation decides; over MOST_AUTHORS it raises instead.
    """
    spark = docs.sparkSession
    rows = author_counts(docs.where(F.col("author").isNotNull())).orderBy("works", "first").select("author").limit(MOST_AUTHORS + 1).collect()
    if len(rows) > MOST_AUTHORS:
        raise ValueError(f"over {MOST_AUTHORS} authors")
    of = spark.createDataFrame(list(split_authors([r.author for r in rows], size_test).items()), "author string, split string")
    return docs.join(of, "author", "left").withColumn("split", F.coalesce("split", F.lit("test"))).select(*docs.columns, "split")
