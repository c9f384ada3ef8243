"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words, hashed to BUCKETS places, each with the logarithm of its count over the text's norm; the
statistics of STATS; the character count that comes with the document. The score is a bias, a linear term and all pairwise
interactions through RANK-dimensional factors, in time linear in the features: half of (the square of a factor's sum less
the sum of its squares). It is trained in numpy on a bounded sample of labelled texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fitting import shift
from .runtime import LOWER, NOT_SPACE, byte_class, hashed_words, lean, passes, utf8

BUCKETS, RANK = 1 << 15, 8
#: At most so many texts of each class are trained on, none longer than this many characters.
MOST, LONGEST = 3000, 40_000
STATS = ("bytes", "words", "lines", "word length", "letters", "digits", "punctuation", "capitals", "white space", "symbols", "words ending in punctuation", "words with symbols inside", "distinct words", "least lines' words", "sentence ends", "beyond ASCII", "characters by metadata")
_CLASSES = [byte_class((65, 90), (97, 122), (128, 255)), byte_class((48, 57)), byte_class((33, 47), (58, 64), (91, 96), (123, 126)), byte_class((65, 90)), byte_class((32, 32), (9, 13)), byte_class((35, 38), (42, 43), (60, 62), (64, 64), (92, 92), (94, 94), (124, 124), (126, 126)), byte_class((46, 46), (33, 33), (63, 63)), byte_class((128, 255))]


def features(data: np.ndarray, offs: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse words (row, bucket, value) and dense statistics (row by len(STATS)) of rows of text."""
    rows, lens = len(offs) - 1, np.diff(offs)
    lower = LOWER[data]
    s, e, h, wb = hashed_words(lower, offs, NOT_SPACE)
    n, of = np.diff(wb), np.repeat(np.arange(rows), np.diff(wb))
    pair = np.unique(of.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24), return_counts=True)
    row, bucket = (pair[0] >> np.uint64(40)).astype(np.int64), (pair[0] & np.uint64(BUCKETS - 1)).astype(np.int64)
    value = 1 + np.log(pair[1])
    norm = np.sqrt(np.bincount(row, value * value, rows))
    value = value / np.maximum(norm[row], 1e-9)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offs])
    share = [sums(c[data]) / np.maximum(lens, 1) for c in _CLASSES]
    lines = sums(data == 10) + 1
    per = lambda x: np.bincount(of, x, rows) / np.maximum(n, 1)
    punct, symbol = _CLASSES[2], _CLASSES[5]
    last = data[e - 1] if len(e) else np.zeros(0, np.uint8)
    cum = np.concatenate([[0], np.cumsum(symbol[data])])
    odd = (cum[e] - cum[s]) > 0
    dense = np.stack([np.log1p(lens), np.log1p(n), np.log1p(lines), per(e - s) / 10, share[0], share[1], share[2], share[3], share[4], share[5], per(punct[last]), per(odd), np.bincount(row, minlength=rows) / np.maximum(n, 1), np.log1p(n / lines), share[6], share[7], np.log1p(np.maximum(n_chars, 0))], 1)
    return row, bucket, value, dense


@dataclass
class Machine:
    """Bias, weights and factors of the words, then those of the statistics, and how the latter are scaled."""

    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def raw(self, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Log odds, by the identity over sums and squares."""
        return self._forward(row, bucket, value, self.scaled(dense))[0]

    def scaled(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.scale, -4, 4) / 4

    def _forward(self, row, bucket, value, x):
        rows = len(x)
        wd, vd = self.w[BUCKETS:], self.v[BUCKETS:]
        vx = self.v[bucket] * value[:, None]
        total = np.stack([np.bincount(row, vx[:, f], rows) for f in range(RANK)], 1) + x @ vd
        square = np.bincount(row, (vx * vx).sum(1), rows) + (x * x) @ (vd * vd).sum(1)
        return self.bias + np.bincount(row, self.w[bucket] * value, rows) + x @ wd + 0.5 * ((total * total).sum(1) - square), total

    def score(self, *found: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(*found), -30, 30)))


def train(texts: pd.DataFrame, rounds: int = 12, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Fit a machine to a frame of text, n_chars and y by Adam on the log loss. With one class only, it gives that class's
    share (a half without any text) to every text."""
    y = texts["y"].to_numpy(float)
    m = Machine(0.0, np.zeros(BUCKETS + len(STATS)), np.zeros((BUCKETS + len(STATS), RANK)), np.zeros(len(STATS)), np.ones(len(STATS)))
    if not len(y) or y.min() == y.max():
        m.bias = float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
        return m
    raw = [t.encode() for t in texts["text"]]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    parts = [features(part, o, texts["n_chars"].to_numpy(float)[a:b]) for a, b, part, o in passes(data, offs)]
    first = np.cumsum([0, *[len(p[3]) for p in parts]])
    row, bucket, value = np.concatenate([p[0] + f for p, f in zip(parts, first, strict=False)]), np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
    dense = np.concatenate([p[3] for p in parts])
    m.mean, m.scale = dense.mean(0), dense.std(0) + 1e-6
    x = m.scaled(dense)
    rng = np.random.default_rng(seed)
    m.v[:] = rng.normal(0, 0.05, m.v.shape)
    weight = np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    bounds = np.searchsorted(row, np.arange(len(y) + 1))
    moments = [np.zeros_like(a) for a in (m.w, m.w, m.v, m.v)]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 128):
            pick = order[i : i + 128]
            at = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in pick])
            r = np.repeat(np.arange(len(pick)), bounds[pick + 1] - bounds[pick])
            b, val, xd = bucket[at], value[at], x[pick]
            z, total = m._forward(r, b, val, xd)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) * weight[pick] / len(pick)
            gw, gv = decay * m.w, decay * m.v
            np.add.at(gw, b, g[r] * val)
            np.add.at(gv, b, (g[r] * val)[:, None] * (total[r] - m.v[b] * val[:, None]))
            gw[BUCKETS:] += g @ xd
            gv[BUCKETS:] += (g[:, None] * xd).T @ total - m.v[BUCKETS:] * (g @ (xd * xd))[:, None]
            m.bias -= rate * float(g.sum())
            step += 1
            for p, d, m1, m2 in ((m.w, gw, *moments[:2]), (m.v, gv, *moments[2:])):
                m1 += 0.1 * (d - m1)
                m2 += 0.001 * (d * d - m2)
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    # scores are of the classes as they occur, not of the balanced ones
    m.bias += float(np.log(y.mean() / (1 - y.mean()))) + shift(texts, y)
    return m


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """key and score (0 to 1) for each row of docs. Null texts score as empty; a null or missing n_chars counts as 0."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # some MB, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            data, offs = utf8(batch.column(1))
            chars = batch.column(2).to_numpy(zero_copy_only=False)
            out = [m.score(*features(part, o, chars[a:b])) for a, b, part, o in passes(data, offs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(out) if out else np.zeros(0))], ["k", "score"])

    chars = F.coalesce(docs[n_chars].cast("double"), F.lit(0.0)) if n_chars and n_chars in docs.columns else F.lit(0.0)
    made = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t"), chars.alias("n")).mapInArrow(lean(run), f"k {docs.schema[key].dataType.simpleString()}, score double")
    return made.withColumnRenamed("k", key)
