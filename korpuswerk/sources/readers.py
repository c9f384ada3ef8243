"""Sources: token tables, evaluation XML, metadata, datasets in JSON lines."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from korpuswerk.functions import text as X
from korpuswerk.schema import OPTIONAL, RECORD

# ---- fixed values ----
#: Columns of token tables by their long and short names in the header.
TAB_COLUMNS = {"xlit": ("Token", "w"), "orig": ("Utf8", "u"), "norm": ("CanonicalToken", "v"), "pos": ("Pos", "p"), "lemma": ("Lemma", "l"), "ws": ("WordSept", "ws")}
METADATA = T.StructType([T.StructField(c, T.StringType()) for c in ("date_", "author", "basename", "bibl", "collection", "firstDate", "textClass", "title")])
# ---- end of fixed values ----


def tab_sentences(content: Column) -> Column:
    """The sentences of a token table, as its text between blank lines. Each blank line ends a sentence, maybe an empty one;
    what stands after the last is no sentence."""
    pieces = F.split(content, r"(?m)^[ \t\x0B\f\r]*(?:\n|(?<=\n)\z)")
    return F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))


def tab_records(files: DataFrame) -> DataFrame:
    """Records of token tables, from (path, value): no white-space flags or text for norm yet.

    A file is one row, as sentence numbers need all of it; everything after is by sentence, without a shuffle.
    """
    place = {name: F.regexp_extract("value", rf"(?m)^%%\$DDC:index\[(\d+)\]=(?:{long}[ =]\S*|\S+[ =]{short})[ \t\r]*$", 1) for name, (long, short) in TAB_COLUMNS.items()}
    checked = {f"i_{n}": F.when(p == "", F.raise_error(F.concat(F.lit(f"no column {n} in "), F.col("path")))).otherwise(p).cast("int") for n, p in place.items()}
    sentences = files.select(X.basename(F.col("path")).alias("basename"), *[c.alias(n) for n, c in checked.items()], F.posexplode(tab_sentences(F.col("value"))).alias("par_idx", "s"))
    lines = F.filter(F.split("s", "\r?\n"), lambda x: (X.strip(x) != "") & ~x.startswith("%%"))
    rows = sentences.withColumn("rows", F.transform(lines, lambda x: F.split(x, "\t")))
    of = lambda n: F.transform("rows", lambda r: F.get(r, F.col(f"i_{n}")))
    norm = F.transform("rows", lambda r: F.when(F.get(r, F.col("i_pos")).startswith("$"), F.get(r, F.col("i_orig"))).otherwise(F.get(r, F.col("i_norm"))))
    ws = F.transform(of("ws"), lambda x, i: (i > 0) & (X.strip(x).cast("int") != 0))
    return rows.select(
        "basename",
        F.col("par_idx").cast("bigint").alias("par_idx"),
        of("orig").alias("orig_tok"),
        of("xlit").alias("orig_xlit"),
        of("lemma").alias("orig_lemma"),
        of("pos").alias("orig_pos"),
        ws.alias("orig_ws"),
        F.flatten(F.transform(norm, X.split_underscores)).alias("norm_tok"),
        F.lit(None).cast("array<boolean>").alias("norm_ws"),
    )


def _whole_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    return reader.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_tabs(spark: SparkSession, path: str) -> DataFrame:
    """Records of all token tables under a path (file, directory or glob)."""
    return tab_records(_whole_files(spark, path))


def xml_sentence(s: ET.Element) -> tuple[list[str], list[str], list[str]]:
    """Tokens of both layers and the orig tokens' classes of a sentence."""
    orig: list[str] = []
    norm: list[str] = []
    classes: list[str] = []
    for w in s.findall("w"):
        old = w.get("old")
        if old is None:
            continue
        new, kind = w.get("new", old), w.get("class")
        if kind == "JOIN":
            inner = w.findall("w")
            before = [x.get("old") for x in inner]
            after = X.join_wrongly_split(before)
            orig += after
            classes += [x.get("class") for x in inner] if after == before else ["LEX"] * len(after)
            norm.append(new)
            continue
        old, new = old.replace("¬", "-"), new.replace("¬", "-")
        if old.endswith("-") and not new.endswith("-"):
            new += "-"
        pieces = _pieces(old)
        orig += pieces
        classes += [kind] * len(pieces)
        norm += _pieces(new)
    return orig, norm, classes


def _pieces(token: str) -> list[str]:
    """At runs of underscores and white space, if there is an underscore or a space."""
    return re.split(r"[_\s]+", token) if "_" in token or " " in token else [token]


_TOKENS = T.ArrayType(T.StringType())


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("par_idx", T.LongType()), T.StructField("is_bad", T.BooleanType()), T.StructField("orig_tok", _TOKENS), T.StructField("norm_tok", _TOKENS), T.StructField("orig_class", _TOKENS)])))
def _parse_xml(content: pd.Series) -> pd.Series:
    def parse(text: str) -> list[dict]:
        found = []
        for i, s in enumerate(ET.fromstring(text.encode()).iter("s")):
            orig, norm, classes = xml_sentence(s)
            found.append({"par_idx": i, "is_bad": "sbad" in s.attrib, "orig_tok": orig, "norm_tok": norm, "orig_class": classes})
        return found

    return content.map(parse)


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """Records of all evaluation XML files under a path, in document order."""
    return xml_records(_whole_files(spark, path))


def xml_records(files: DataFrame) -> DataFrame:
    """Records of evaluation XML, from (path, value); a file is one row to parse."""
    rows = files.select(X.basename(F.col("path")).alias("basename"), F.explode(_parse_xml("value")).alias("s"))
    empty = F.lit(None).cast("array<boolean>")
    return rows.select("basename", "s.*", empty.alias("orig_ws"), empty.alias("norm_ws"))


def metadata_from_lines(lines: DataFrame) -> DataFrame:
    """(basename, date, author, genre, title) from (n, value): JSON lines and their order; the first of a basename counts.
    Lines whose two dates differ fail the job."""
    parsed = lines.select("n", F.from_json("value", METADATA).alias("m")).select("n", "m.*").where("basename IS NOT NULL")
    date = F.when(F.col("date_").eqNullSafe(F.col("firstDate")), F.col("firstDate")).otherwise(F.raise_error(F.concat(F.lit("two dates for "), F.col("basename"))))
    made = F.struct(date.cast("int").alias("date"), "author", F.col("textClass").alias("genre"), "title")
    return parsed.groupBy("basename").agg(F.min_by(made, "n").alias("r")).select("basename", "r.*")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata of documents from JSON lines, by file and place in it."""
    lines = spark.read.text(path).where("trim(value) != ''")
    return metadata_from_lines(lines.select(F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("n"), "value"))


def read_dataset(spark: SparkSession, paths: str | list[str], extra: T.StructType | None = None, recursive: bool = True) -> DataFrame:
    """Records from JSON lines files, directories or globs, with the declared schema: no pass to infer it. Columns beyond it
    come with `extra`; optional ones that no record has are left out by name through drop_absent()."""
    schema = T.StructType([*RECORD.fields, *OPTIONAL.fields, *(extra.fields if extra else [])])
    return spark.read.schema(schema).option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.jsonl").json(paths)


def drop_absent(records: DataFrame) -> DataFrame:
    """Without the optional columns that are null everywhere, by one aggregate over them."""
    names = [f.name for f in OPTIONAL.fields if f.name in records.columns]
    seen = records.agg(*[F.count(c).alias(c) for c in names]).first()
    return records.drop(*[c for c in names if not seen[c]])


def first_records(spark: SparkSession, path: str) -> DataFrame:
    """Each document's metadata, from its record of the least par_idx; only these columns are read."""
    schema = T.StructType([f for f in RECORD.fields if f.name in ("basename", "par_idx", "date", "genre", "author")])
    rows = spark.read.schema(schema).option("pathGlobFilter", "*.jsonl").json(path)
    return rows.groupBy("basename").agg(F.min_by(F.struct("date", "genre", "author"), F.coalesce("par_idx", F.lit(0))).alias("r")).select("basename", "r.*")
