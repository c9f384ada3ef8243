"""n-gram alignment lexicons: how often each pair of n-grams occurs, and in how many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpuswerk.functions import alignment as A
from korpuswerk.functions import text as X
from korpuswerk.schema import require


def pairs(df: DataFrame, transliterate: bool = False, keep_none: bool = False, sep: str = X.SEPARATOR, *keep: str) -> DataFrame:
    """(orig, norm) n-grams of every record, one row for each, with the columns in keep."""
    require(df.columns, "orig_tok", "norm_tok", "alignment", *keep)
    orig = X.transliterate_all(F.col("orig_tok")) if transliterate else F.col("orig_tok")
    grouped = df.select(orig.alias("o"), F.col("norm_tok").alias("n"), A.groups(F.col("alignment")).alias("g"), *keep)
    made = grouped.select(F.explode(A.ngrams(F.col("g"), F.col("o"), F.col("n"), keep_none, sep)).alias("x"), *keep)
    return made.select("x.orig", "x.norm", *keep)


def build(df: DataFrame, document: Column | str = "basename", transliterate: bool = False, keep_none: bool = False, sep: str = X.SEPARATOR) -> DataFrame:
    """(orig, norm, freq, docs): total frequency and the number of documents with the pair.

    Pairs are first summed by document, so that the second sum sees a row for each pair and document; no distinct count is
    kept in memory, and a pair that is everywhere is already small when it is shuffled.
    """
    doc = F.col(document) if isinstance(document, str) else document
    named = pairs(df.withColumn("_doc", doc), transliterate, keep_none, sep, "_doc")
    by_doc = named.groupBy("orig", "norm", "_doc").agg(F.count("*").alias("n"))
    return by_doc.groupBy("orig", "norm").agg(F.sum("n").alias("freq"), F.count("*").alias("docs"))
