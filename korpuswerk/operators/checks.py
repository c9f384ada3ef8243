"""Whether records keep their invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korpuswerk.functions import text as X
from korpuswerk.schema import LAYERS


def faults(layer: str) -> Column:
    """What is wrong with a layer, as a list of names; empty if nothing is."""
    raw, tok, ws, spans = (F.col(f"{layer}{p}") for p in ("", "_tok", "_ws", "_spans"))
    sizes = (F.size(tok) == F.size(ws)) & (F.size(tok) == F.size(spans))
    cut = F.transform(spans, lambda s: F.substring(raw, s[0] + 1, s[1] - s[0]))
    tests = {"sizes": sizes, "text": X.consistent(raw, tok, ws), "spans": F.coalesce(cut == tok, F.lit(False))}
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(f"{layer}: {name}")) for name, ok in tests.items()]))


def quarantine(records: DataFrame) -> DataFrame:
    """records with faults: what is wrong with either layer."""
    return records.withColumn("faults", F.concat(*[faults(layer) for layer in LAYERS]))


def strict(records: DataFrame) -> DataFrame:
    """records as they are; the job fails at the first row with a fault."""
    bad = quarantine(records)
    message = F.concat(F.lit("record breaks "), F.array_join("faults", ", "))
    return bad.withColumn("faults", F.when(F.size("faults") > 0, F.raise_error(message))).where("faults IS NULL OR size(faults) = 0").drop("faults")
