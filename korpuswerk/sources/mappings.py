"""Mapping files: read on the driver, as they are dictionaries written by hand. Later rows and files win."""

from __future__ import annotations

import csv
import glob
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values ----
QUOTE = "`"
SNIFFED = 1024
TRUE = ("true", "yes", "t", "1")
# ---- end of fixed values ----


def resolve(path: str) -> list[str]:
    """A file itself, a directory's entries, or what a glob finds; sorted."""
    if os.path.isfile(path):
        return [path]
    return sorted(os.path.join(path, x) for x in os.listdir(path)) if os.path.isdir(path) else sorted(glob.glob(path))


def dataset_files(path: str) -> list[str]:
    """All JSON lines files under a directory, or the one file; ValueError if there is neither."""
    if os.path.isdir(path):
        return sorted(glob.glob(os.path.join(path, "**", "*.jsonl"), recursive=True))
    if os.path.isfile(path):
        return [path]
    raise ValueError(f"no file or directory: {path}")


def _pairs(paths: list[str], delimiters: str | None) -> list[tuple[str, str]]:
    """The rows of all files; a path may be a directory or a glob, and FileNotFoundError if there is nothing."""
    out = []
    for given in paths:
        if not resolve(given):
            raise FileNotFoundError(given)
    for path in (x for given in paths for x in resolve(given)):
        with open(path, newline="", encoding="utf-8") as f:
            dialect = csv.Sniffer().sniff(f.read(SNIFFED), delimiters)
            f.seek(0)
            for row in csv.reader(f, dialect, quotechar=QUOTE):
                assert len(row) == 2, f"{path}: {row} isn't a pair"
                out.append((row[0], row[1]))
    return out


def token_to_token(paths: list[str], delimiters: str | None = None) -> dict[str, str]:
    return dict(_pairs(paths, delimiters))


def token_to_tokens(paths: list[str], delimiters: str | None = None) -> dict[str, list[str]]:
    return {a: b.split(" ") for a, b in _pairs(paths, delimiters)}


def ngram_to_ngram(paths: list[str], delimiters: str | None = None) -> dict[tuple[str, ...], tuple[str, ...]]:
    return {tuple(a.split(" ")): tuple(b.split(" ")) for a, b in _pairs(paths, delimiters)}


def rules(path: str) -> set[str]:
    """Rule ids, one a line."""
    with open(path, encoding="utf-8") as f:
        return {x for line in f if (x := line.strip())}


def corrections(spark: SparkSession, paths: list[str], raw_label: str, uid: tuple[str, ...] = ("basename", "par_idx")) -> DataFrame:
    """(uid columns, raw, n): corrected texts from .csv and .tsv files with a header; other files are passed over. n is the
    row's place, by which the last of several wins. ValueError if a column is missing."""
    rows: list[tuple] = []
    for path in paths:
        if not path.endswith((".csv", ".tsv")):
            continue
        with open(path, newline="", encoding="utf-8") as f:
            head = f.readline()
            f.seek(0)
            found = csv.DictReader(f, delimiter="\t" if head.count("\t") >= head.count(",") else ",")
            if missing := {*uid, raw_label} - set(found.fieldnames or ()):
                raise ValueError(f"{path}: missing {sorted(missing)}")
            rows += [(*[r[c] for c in uid], r[raw_label], len(rows) + i) for i, r in enumerate(found)]
    kinds = ", ".join(f"{c} string" for c in uid)
    return spark.createDataFrame(rows, f"{kinds}, raw string, n bigint")


def keyed(pairs: DataFrame) -> DataFrame:
    """Of (key, value, n) rows the last of each key, for mappings that are tables."""
    return pairs.groupBy("key").agg(F.max_by("value", "n").alias("value"))


def options(words: list[str] | None) -> dict[str, object]:
    """k=v pairs: mapping_files is a list split at commas, {TAB} a tab, transliterate_source a truth value."""
    out: dict[str, object] = {}
    for word in (w for x in words or [] for w in x.split()):
        k, _, v = word.partition("=")
        v = v.replace("{TAB}", "\t")
        out[k] = v.split(",") if k == "mapping_files" else v.lower() in TRUE if k == "transliterate_source" else v
    return out
