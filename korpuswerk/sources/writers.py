"""Sinks: datasets and lexicons as JSON lines. Spark writes; the driver then only renames files."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _fs(df: DataFrame, path: str):
    jvm = df.sparkSession._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _parts(fs, path) -> list:
    return [x.getPath() for x in fs.listStatus(path) if x.getPath().getName().startswith("part-")]


def _move(fs, source, target) -> None:
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(source, target):
        raise OSError(f"can't rename {source} to {target}")


def write_grouped(records: DataFrame, out: str, by: str = "basename", order: tuple[str, ...] = ("par_idx",)) -> None:
    """A file {value}.jsonl for each value of a column, its rows in order. Rows of a value need not be together before."""
    fs, path = _fs(records, out)
    scratch = f"{out}/_scratch-{uuid.uuid4().hex}"
    dealt = records.withColumn("_file", F.col(by)).repartition(F.col("_file")).sortWithinPartitions("_file", *[c for c in order if c in records.columns])
    dealt.write.partitionBy("_file").option("ignoreNullFields", False).json(scratch)
    for x in fs.listStatus(path(scratch)):
        if x.isDirectory():
            name = unquote(x.getPath().getName().partition("=")[2])
            for part in _parts(fs, x.getPath()):
                _move(fs, part, path(f"{out}/{name}.jsonl"))
    fs.delete(path(scratch), True)


def write_single(records: DataFrame, out: str, order: tuple[str, ...] = ("basename", "par_idx")) -> None:
    """One file, its rows in order. An empty table makes an empty file."""
    fs, path = _fs(records, out)
    scratch = f"{out}.scratch-{uuid.uuid4().hex}"
    cols = [c for c in order if c in records.columns]
    (records.orderBy(*cols) if cols else records).coalesce(1).write.option("ignoreNullFields", False).json(scratch)
    parts = _parts(fs, path(scratch))
    if parts:
        _move(fs, parts[0], path(out))
    else:
        fs.create(path(out), True).close()
    fs.delete(path(scratch), True)


def write_lexicon(lexicon: DataFrame, out: str) -> None:
    """(orig, norm, freq, docs) in one file, sorted by code points."""
    write_single(lexicon.select("orig", "norm", "freq", "docs"), out, ("orig", "norm"))


def write_splits(records: DataFrame, splits: DataFrame, outs: dict[str, str]) -> None:
    """The records of each split's documents, as files by document; the input is left alone."""
    named = records.join(splits.select("basename", "split"), "basename")
    for name, out in outs.items():
        write_grouped(named.where(F.col("split") == name).drop("split"), out)
