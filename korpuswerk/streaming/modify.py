"""Modifiers over a stream of records. They look at one record at a time, so they need neither watermark nor state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from korpuswerk.operators import lexicon
from korpuswerk.operators.modifiers import Modifier
from korpuswerk.schema import RECORD


def read(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    """A stream of the records in JSON lines files that appear under a path."""
    return spark.readStream.schema(RECORD).option("maxFilesPerTrigger", files_at_once).option("pathGlobFilter", "*.jsonl").json(path)


def modify(records: DataFrame, modifiers: list[Modifier], out: str, checkpoint: str) -> StreamingQuery:
    """Write records, modified one after the other, as Parquet; what is there is done, then it ends."""
    for m in modifiers:
        records = records.transform(m)
    return records.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def frequencies(records: DataFrame, name: str, **options: object) -> StreamingQuery:
    """A running lexicon (orig, norm, freq) in a memory table; document frequencies would need the documents as state."""
    counted = lexicon.pairs(records, **options).groupBy("orig", "norm").agg(F.count("*").alias("freq"))
    return counted.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
