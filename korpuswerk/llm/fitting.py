"""What the classifiers share: bounded training samples of labelled texts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, most: int, longest: int, key: str = "doc_id", text: str = "text", more: tuple[str, ...] = ()) -> pd.DataFrame:
    """At most `most` labelled texts of each class, as a frame of text, y and the columns in more, in a fixed order.

    Only labels whose row satisfies keep are read. Of these, each class's first by a hash of the key are taken, so more
    data changes the sample but never its size; texts over `longest` characters are left out of training. Of several
    labels of a key the highest counts, of several texts the first in order. Null keys, labels and texts take no part.
    """
    named = labels.where(keep & labels[key].isNotNull() & labels[label].isNotNull()).groupBy(labels[key].alias("k")).agg((F.max(label) > 0).cast("int").alias("y"))
    parts = [named.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(most) for y in (0, 1)]
    chosen = F.broadcast(parts[0].union(parts[1]))  # at most twice `most` rows of two numbers
    texts = docs.select(docs[key].alias("k"), F.struct(docs[text].cast("string").alias("text"), *[docs[c].alias(c) for c in more]).alias("r")).where(docs[text].isNotNull() & (F.length(docs[text]) <= longest))
    found = texts.join(chosen, "k").groupBy("k").agg(F.min("r").alias("r"), F.max("y").alias("y"))
    out = found.select("k", "r.*", "y").toPandas().sort_values("k", kind="stable").reset_index(drop=True)
    # how often the class really occurs among the labels read, as the sample may be more even
    out.attrs["share"] = named.agg(F.avg("y")).first()[0]
    return out


def shift(texts: pd.DataFrame, y: np.ndarray) -> float:
    """What to add to log odds fitted to the sample's class share to get those at the share among all labels."""
    share = texts.attrs.get("share")
    if not share or share >= 1 or not 0 < y.mean() < 1:
        return 0.0
    return float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean())))
