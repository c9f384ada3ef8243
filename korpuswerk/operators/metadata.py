"""Documents' metadata: joined to their records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS = ("date", "author", "genre", "title")


def missing(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """The basenames of records that have no metadata."""
    return records.select("basename").distinct().join(metadata.select("basename"), "basename", "left_anti")


def join(records: DataFrame, metadata: DataFrame, strict: bool = True) -> DataFrame:
    """records with their document's metadata. strict: a record without any fails the job when its row is read, so that no
    pass of its own is needed; otherwise its metadata are null."""
    meta = metadata.select("basename", *[c for c in COLUMNS if c in metadata.columns], F.lit(True).alias("_known"))
    joined = records.drop(*[c for c in COLUMNS if c in records.columns]).join(meta, "basename", "left")
    if strict:
        known = F.when(F.col("_known"), F.col("basename")).otherwise(F.raise_error(F.concat(F.lit("no metadata for "), F.coalesce("basename", F.lit("null")))))
        joined = joined.withColumn("basename", known)
    return joined.drop("_known")
