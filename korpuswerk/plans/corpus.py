"""Sentence records from the driver's documents, in Spark and in SQL: a non-empty line is a sentence, its words are tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Replacements that the queries make: token to token, and token to tokens.
ONE_TO_ONE = {"the": "dhe", "of": "off", "und": "unde", "les": "lés"}
ONE_TO_MANY = {"that": ["th", "at"], "with": ["wi", "t", "h"], "die": ["d", "ie"]}
#: n-grams to m-grams of the cross-layer replacement.
MANY_TO_MANY = {("to", "the"): ("tothe",), ("and",): ("an", "d"), ("of", "the", "and"): ("x",), ("is",): ("iz",), ("is", "and"): ("isand", "and")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows on all cores where their files give fewer partitions than there are cores: a small table's one row group is
    one task. A table of many row groups stays as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(basename, par_idx, lang, source, orig, orig_tok)."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    lines = docs.select(F.concat(F.lit("doc"), "doc_id").alias("basename"), "lang", "source", F.posexplode(F.split("text", "\n")).alias("par_idx", "orig"))
    return lines.where("orig != ''").withColumn("orig_tok", F.split("orig", " "))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences with norm_tok (as orig_tok) and an alignment that has groups and gaps: `of` goes with the token before,
    `is` is left alone, `to` stands for two tokens."""
    pairs = """flatten(transform(orig_tok, (t, i) -> CASE
        WHEN t = 'of' AND i > 0 THEN array(array(i, i - 1), array(CAST(NULL AS INT), i))
        WHEN t = 'is' THEN array(array(i, CAST(NULL AS INT)), array(CAST(NULL AS INT), i))
        WHEN t = 'to' AND i + 1 < size(orig_tok) THEN array(array(i, i), array(i, i + 1))
        ELSE array(array(i, i)) END))"""
    return sentences(spark, sf_dir).withColumns({"norm_tok": F.col("orig_tok"), "alignment": F.expr(pairs)})


SENTENCES = """
s AS (
  SELECT basename, lang, source, CAST(par_idx - 1 AS BIGINT) AS par_idx, orig, string_split(orig, ' ') AS tok
  FROM (SELECT 'doc' || doc_id AS basename, lang, source, unnest(string_split(text, chr(10))) AS orig, generate_subscripts(string_split(text, chr(10)), 1) AS par_idx FROM documents)
  WHERE orig <> '')"""

RECORDS = f"""{SENTENCES},
r AS (SELECT *, row_number() OVER () AS id FROM s),
t AS (SELECT id, basename, unnest(tok) AS w, generate_subscripts(tok, 1) - 1 AS i, len(tok) AS n FROM r),
a AS (
  SELECT id, basename, i AS o, i - 1 AS m FROM t WHERE w = 'of' AND i > 0
  UNION ALL SELECT id, basename, NULL, i FROM t WHERE w = 'of' AND i > 0
  UNION ALL SELECT id, basename, i, NULL FROM t WHERE w = 'is'
  UNION ALL SELECT id, basename, NULL, i FROM t WHERE w = 'is'
  UNION ALL SELECT id, basename, i, i FROM t WHERE w = 'to' AND i + 1 < n
  UNION ALL SELECT id, basename, i, i + 1 FROM t WHERE w = 'to' AND i + 1 < n
  UNION ALL SELECT id, basename, i, i FROM t WHERE w <> 'is' AND NOT (w = 'of' AND i > 0) AND NOT (w = 'to' AND i + 1 < n)),
by_trg AS (SELECT id, m, list_sort(list(DISTINCT o) FILTER (WHERE o IS NOT NULL)) AS src, bool_or(o IS NULL) AS src_null FROM a GROUP BY id, m),
by_src AS (SELECT id, o, list_sort(list(DISTINCT m) FILTER (WHERE m IS NOT NULL)) AS trg, bool_or(m IS NULL) AS trg_null FROM a GROUP BY id, o),
g AS (
  SELECT DISTINCT x.id, coalesce(x.src, []) AS src, x.src_null, coalesce(y.trg, []) AS trg, y.trg_null
  FROM by_trg x JOIN by_src y ON x.id = y.id AND x.src[1] IS NOT DISTINCT FROM y.o),
p AS (
  SELECT basename, array_to_string(list_transform(src, lambda i: tok[i + 1]), '{{sep}}') AS orig, array_to_string(list_transform(trg, lambda i: tok[i + 1]), '{{sep}}') AS norm
  FROM g JOIN r USING (id))"""
