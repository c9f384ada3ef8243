"""LM scoring by context-tree weighting over bytes.

A text is its UTF-8 bytes and an end mark. Each byte is eight binary decisions; a decision's context is the bits of the
byte so far and the last 0..DEPTH bytes. At each node a Krichevsky-Trofimov estimate is mixed, half and half, with what
its children say, from the deepest context up to the empty one. The weights that the training text gives follow from block
probabilities, so a byte's code length after training is a product of mixtures along its context path.

All contexts of all documents are counted (nothing is sampled or hashed together): tasks send counts of (context, byte)
grams, which are summed by the shuffle. Nodes of depth 3 and more are worked out by the last three context bytes, runs of
whole contexts at a time, so that a task holds a run and no more than one large context. Above that there are few nodes:
at most some 40,000 pairs of bytes occur in UTF-8, of 255 nodes each, so depths 2 to 0 are worked out on the driver.

Grams and words that occur often are broadcast, HEAD_GRAMS and HEAD_WORDS of them at most, and looked up as arrays. What a
document has beyond these goes through a join; so neither the model nor the vocabulary needs to fit anywhere, and no join
key is a frequent one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import LOWER, NOT_SPACE, PASS_BYTES, HashTable, discard, hashed_words, lean, materialize, passes, utf8

DEPTH = 5
#: Depth down to which nodes are worked out by the tasks, and grams that a task works out at once.
SPLIT, RUN = 3, 1 << 17
#: Counts that a task sums up before it sends them.
HELD = 1 << 21
PAD, END = 0xFE, 0xFF  # bytes that UTF-8 never has
HEAD_WORDS, HEAD_GRAMS = 1 << 20, 1 << 21
WORD, GRAM = 0, 1
_HALF = np.log(0.5)


def held_out(key: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the key as text leaves the rest; a null key doesn't."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod == rest, F.lit(False))


def lgamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function, for x of a half and more."""
    y = x + 8.0
    down = np.ones_like(y)
    for k in range(8):
        down *= x + k
    i = 1 / y
    i2 = i * i
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + i * (1 / 12 - i2 * (1 / 360 - i2 * (1 / 1260 - i2 / 1680))) - np.log(down)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that a Krichevsky-Trofimov estimator gives to n0 zeros and n1 ones."""
    n0, n1 = n0.astype(float), n1.astype(float)
    return lgamma(n0 + 0.5) + lgamma(n1 + 0.5) - lgamma(n0 + n1 + 1.0) - np.log(np.pi)


def grams(data: np.ndarray, offs: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """For each row its bytes and end mark, each packed behind its `depth` bytes of context (row r has length + 1)."""
    rows, lens = len(offs) - 1, np.diff(offs)
    buf = np.full(len(data) + rows * (depth + 1), PAD, np.uint8)
    shift = np.arange(rows) * (depth + 1) + depth
    buf[np.arange(len(data)) + np.repeat(shift, lens)] = data
    buf[offs[1:] + shift] = END
    g = np.zeros(len(buf) - depth, np.int64)
    for k in range(depth + 1):
        g <<= 8
        g |= buf[k : len(buf) - depth + k]
    own = np.ones(len(g), bool)
    own[(offs[1:-1] + shift[:-1] + 1)[:, None] + np.arange(depth) - depth] = False
    return g[own]


def gram_runs(data: np.ndarray, offs: np.ndarray, depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of each gram, grams) of a pass; a row longer than a pass comes in several runs."""
    rows, lens = len(offs) - 1, np.diff(offs)
    if rows != 1 or lens[0] <= PASS_BYTES:
        yield np.repeat(np.arange(rows), lens + 1), grams(data, offs, depth)
        return
    for a in range(0, len(data), PASS_BYTES):
        b = min(a + PASS_BYTES, len(data))
        part = np.concatenate([np.full(max(0, depth - a), PAD, np.uint8), data[max(0, a - depth) : b], np.full(int(b == len(data)), END, np.uint8)])
        g = np.zeros(len(part) - depth, np.int64)
        for k in range(depth + 1):
            g <<= 8
            g |= part[k : len(part) - depth + k]
        yield np.zeros(len(g), np.int64), g


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(np.concatenate(keys), return_inverse=True)
    return u, np.bincount(inv, np.concatenate(counts), len(u)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """(kind, key, n) of text, train: words of training texts, grams of all (n is 0 for those of held-out texts)."""
    found: dict[int, tuple[list, list]] = {WORD: ([], []), GRAM: ([], [])}
    held = 0

    def out() -> Iterator[pa.RecordBatch]:
        for kind, (keys, counts) in found.items():
            if keys:
                u, n = _summed(keys, counts)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(u), kind, np.int8)), pa.array(u), pa.array(n)], ["kind", "key", "n"])
                keys.clear()
                counts.clear()

    def add(kind: int, x: np.ndarray, weight: int) -> int:
        u, n = np.unique(x, return_counts=True)
        found[kind][0].append(u)
        found[kind][1].append(n * weight)
        return len(u)

    for batch in batches:
        data, offs = utf8(batch.column(0))
        train = batch.column(1).to_numpy(zero_copy_only=False)
        for a, b, part, o in passes(data, offs):
            keep = train[a:b]
            for of, g in gram_runs(part, o, depth):
                held += add(GRAM, g[keep[of]], 1) + add(GRAM, g[~keep[of]], 0)
            _, _, w, wb = hashed_words(LOWER[part], o, NOT_SPACE)
            held += add(WORD, w.view(np.int64)[np.repeat(keep, np.diff(wb))], 1)
            if held > HELD:
                held = 0
                for keys, counts in found.values():
                    if keys:
                        u, n = _summed(keys, counts)
                        keys[:], counts[:] = [u], [n]
                        held += len(u)
                if held > HELD // 2:
                    yield from out()
                    held = 0
    yield from out()


def deep(keys: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all grams with the same last SPLIT context bytes, of one or several of these contexts: each one's eight bit
    probabilities at that depth, and its nodes: names (the context's bytes, then one byte for the place: 2 to the bit,
    less 1, plus the bits before), log block probabilities, zeros and ones."""
    p = np.empty((len(keys), 8))
    below: list = [None] * 8
    places, logs, zeros, ones = [], [], [], []
    for d in range(depth, SPLIT - 1, -1):
        u, inv = np.unique(keys & ((1 << 8 * (d + 1)) - 1 if d < 7 else -1), return_inverse=True)  # depth 7 fills all 64 bits
        c = np.bincount(inv, n, len(u))
        for i in range(8):
            node = u >> (8 - i)
            first = np.concatenate([[0], np.flatnonzero(np.diff(node)) + 1])
            bit = (u >> (7 - i)) & 1
            n1 = np.add.reduceat(c * bit, first)
            n0 = np.add.reduceat(c, first) - n1
            lk = log_kt(n0, n1)
            at = np.repeat(np.arange(len(first)), np.diff([*first, len(u)]))
            kt = np.where(bit == 1, n1[at] + 0.5, n0[at] + 0.5) / (n0 + n1 + 1.0)[at]
            names = node[first]
            if d == depth:
                lw = lk
                p[:, i] = kt[inv]
            else:
                was, lw_was = below[i]
                up = np.searchsorted(names, was & ((1 << 8 * (d + 1) - (8 - i)) - 1))
                lw = np.logaddexp(_HALF + lk, _HALF + np.bincount(up, lw_was, len(names)))
                w = np.exp(_HALF + lk - lw)[at][inv]
                p[:, i] = w * kt[inv] + (1 - w) * p[:, i]
            below[i] = (names, lw)
            if d == SPLIT:
                places.append(names >> i << 8 | (1 << i) - 1 + (names & ((1 << i) - 1)))
                logs.append(lw)
                zeros.append(n0)
                ones.append(n1)
    return p, np.concatenate(places), np.concatenate(logs), np.concatenate(zeros).astype(np.int64), np.concatenate(ones).astype(np.int64)


class Top:
    """The nodes of depths 2 to 0. key: of those of depth 2, the context's bytes and the place; logs: what their children
    say. Weights and estimates lie dense by context and place, of the contexts that occur: 4 KB each."""

    def __init__(self, key: np.ndarray, logs: np.ndarray, n0: np.ndarray, n1: np.ndarray):
        pairs, at = np.unique(key >> 8, return_inverse=True)
        self.row = np.zeros(1 << 16, np.int32)
        self.row[pairs] = np.arange(len(pairs))
        self.levels = []
        shape, at, place = (max(1, len(pairs)), 255), at, key & 255
        for up in (pairs & 255, np.zeros(256, np.int64), None):
            zeros, ones, below = np.zeros(shape), np.zeros(shape), np.zeros(shape)
            for table, x in ((zeros, n0), (ones, n1), (below, logs)):
                np.add.at(table, (at, place), x)
            lk = log_kt(zeros, ones)
            lw = np.logaddexp(_HALF + lk, _HALF + below)
            self.levels.append((np.exp(_HALF + lk - lw), (ones + 0.5) / (zeros + ones + 1)))
            if up is not None:
                n0, n1, logs = zeros[: len(up)].ravel(), ones[: len(up)].ravel(), lw[: len(up)].ravel()
                at, place = np.repeat(up, 255), np.tile(np.arange(255), len(up))
                shape = (256 if len(self.levels) == 1 else 1, 255)

    def log10(self, keys: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log probabilities of the grams' bytes, from their bits' probabilities at depth SPLIT."""
        sym, contexts = keys & 255, (self.row[(keys >> 8) & 65535], (keys >> 8) & 255, 0)
        out = np.zeros(len(keys))
        for i in range(8):
            place, bit, q = (1 << i) - 1 + (sym >> (8 - i)), (sym >> (7 - i)) & 1, p[:, i]
            for (weight, one), at in zip(self.levels, contexts, strict=True):
                w, est = weight[at, place], one[at, place]
                q = w * np.where(bit == 1, est, 1 - est) + (1 - w) * q
            out += np.log10(q)
        return out


def counts(docs: DataFrame, key: str, text: str, train: Column, depth: int = DEPTH) -> DataFrame:
    """(kind, key, n): words of the training rows by hash, and grams of all rows, with their counts in the training rows.

    Words are told apart by 64-bit hashes; two of a million million words share one with a chance of about 3 in 100,000 a
    word, and would then be counted together."""
    picked = docs.select(docs[text].cast("string").alias("t"), train.alias("train"))
    return picked.mapInArrow(lean(lambda b: _count(b, depth)), "kind tinyint, key bigint, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def model(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(key, n, lp): every gram with its training count and log10 probability, from counts() as a written table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (key, n) sorted by their last SPLIT context bytes."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def made(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            p, name, logs, n0, n1 = deep(keys, n, depth)
            a, b = len(keys), len(name)
            ends = np.concatenate([np.arange(a + 1), np.full(b, a)]).astype(np.int32) * 64
            bits = pa.Array.from_buffers(pa.binary(), a + b, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(p))])
            cols = (np.repeat([False, True], [a, b]), np.concatenate([keys, name]), bits, np.concatenate([np.zeros(a), logs]), np.concatenate([n, n0]), np.concatenate([np.zeros(a, np.int64), n1]))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["node", "key", "p", "lw", "n0", "n1"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(k) for k, _ in held) >= RUN:
                keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
                context = (keys >> 8) & ((1 << 8 * SPLIT) - 1)
                cut = int(np.flatnonzero(context != context[-1])[-1]) + 1 if context[0] != context[-1] else 0
                if cut:
                    yield made(keys[:cut], n[:cut])
                held = [(keys[cut:], n[cut:])]
        if held:
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            if len(keys):
                yield made(keys, n)

    context = F.expr(f"shiftright(key, 8) & {(1 << 8 * SPLIT) - 1}")
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = counted.where(F.col("kind") == GRAM).select("key", "n", context.alias("context")).repartition(parts, "context").sortWithinPartitions("context").select("key", "n")
    tree = materialize(dealt.mapInArrow(lean(work), "node boolean, key bigint, p binary, lw double, n0 bigint, n1 bigint"), "tree")
    # at most 255 rows for each pair of bytes that occurs
    top = tree.where("node").groupBy((F.col("key") % (1 << 24)).alias("key")).agg(F.sum("lw").alias("lw"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    sent = counted.sparkSession.sparkContext.broadcast(Top(*[top.column(c).to_numpy() for c in ("key", "lw", "n0", "n1")]))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            p = np.frombuffer(utf8(batch.column(1))[0].tobytes(), float).reshape(-1, 8)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sent.value.log10(keys, p))], ["key", "n", "lp"])

    out = materialize(tree.where("not node").select("key", "p", "n0").mapInArrow(lean(finish), "key bigint, n bigint, lp double"), "model")
    discard(tree)
    return out


def _floor(table: DataFrame, most: int) -> int:
    """The least power of two (or 0) such that at most `most` rows have n of so many."""
    sizes = table.groupBy(F.length(F.bin("n")).alias("b"), (F.col("n") == 0).alias("z")).count().collect()  # at most 65 rows
    left = most
    for r in sorted(sizes, key=lambda r: (-r.b, r.z)):
        left -= r["count"]
        if left < 0:
            return 1 << r.b if not r.z else 1
    return 0


_SENT: dict[str, tuple] = {}


def _heads(token: str, sent) -> tuple:
    """The tables of a broadcast, built once in a worker."""
    if token not in _SENT:
        _SENT.clear()
        wk, wv, gk, gv = sent.value
        _SENT[token] = (HashTable(wk), np.append(wv, 0), HashTable(gk), np.append(gv, 0.0))
    return _SENT[token]


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", mod: int = 7, rest: int = 2, depth: int = DEPTH, head_words: int = HEAD_WORDS, head_grams: int = HEAD_GRAMS) -> DataFrame:
    """For each row of docs: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probability of the
    text and its end), bits_per_byte (code length for each byte, the end mark's included).

    Null texts are empty: one token, the end. Null keys belong to training. Repeated rows are counted and scored each. With
    no training row at all every estimate is the prior's.
    """
    spark = docs.sparkSession
    out_of = held_out(docs[key], mod, rest)
    counted = materialize(counts(docs, key, text, ~out_of, depth), "counts")
    vocabulary = counted.where(F.col("kind") == WORD).select("key", "n")
    lm = model(counted, depth)
    ends = docs.where(~out_of).count()
    whole = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, total = whole.n + ends, whole.n + ends + whole.v + (ends > 0) + 1
    floor_w, floor_g = _floor(vocabulary, head_words), _floor(lm, head_grams)
    w, g = vocabulary.where(F.col("n") >= floor_w).toArrow(), lm.where(F.col("n") >= floor_g).select("key", "lp").toArrow()
    sent = spark.sparkContext.broadcast((w.column("key").to_numpy(), w.column("n").to_numpy(), g.column("key").to_numpy(), g.column("lp").to_numpy()))
    all_words, token = floor_w <= 1, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wt, wn, gt, glp = _heads(token, sent)
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offs = utf8(batch.column(1))
            for a, b, part, o in passes(data, offs):
                rows, lens = b - a, np.diff(o)
                lp, lost_of, lost_g = np.zeros(rows), [], []
                for of, keys in gram_runs(part, o, depth):
                    at = gt.find(keys)
                    lp += np.bincount(of, glp[at], rows)
                    lost_of.append(of[at < 0])
                    lost_g.append(keys[at < 0])
                tail_g, bounds_g = np.concatenate(lost_g), np.searchsorted(np.concatenate(lost_of), np.arange(rows + 1))
                _, _, wkeys, wb = hashed_words(LOWER[part], o, NOT_SPACE)
                wkeys, wof = wkeys.view(np.int64), np.repeat(np.arange(rows), np.diff(wb))
                at = wt.find(wkeys)
                c = wn[at]
                base = np.bincount(wof, np.where((at >= 0) | all_words, np.log10((c + 1) / total), 0.0), rows) + np.log10((ends + 1) / total)
                known = np.bincount(wof, c > 0, rows).astype(np.int64) + (ends > 0)
                lost = (at < 0) & (not all_words)
                tail_w, bounds_w = wkeys[lost], np.searchsorted(wof[lost], np.arange(rows + 1))
                lists = [pa.ListArray.from_arrays(pa.array(x.astype(np.int32)), pa.array(y)) for x, y in ((bounds_w, tail_w), (bounds_g, tail_g))]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(rid, rid + rows)), batch.column(0).slice(a, rows), pa.array(np.diff(wb) + 1), pa.array(known), pa.array(base), pa.array(lp), pa.array(lens + 1), *lists], ["rid", "k", "n_tokens", "n_known", "base", "lp", "n_bytes", "tail_w", "tail_g"])
                rid += rows

    kind = docs.schema[key].dataType.simpleString()
    heads = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t")).mapInArrow(lean(run), f"rid bigint, k {kind}, n_tokens bigint, n_known bigint, base double, lp double, n_bytes bigint, tail_w array<bigint>, tail_g array<bigint>")
    heads = materialize(heads, "heads")
    tails = [
        heads.select("rid", F.explode("tail_w").alias("key")).join(vocabulary.where(F.col("n") < floor_w), "key", "left").select("rid", F.coalesce("n", F.lit(0)).alias("n")).groupBy("rid").agg(F.sum(F.log10((F.col("n") + 1) / total)).alias("base2"), F.count(F.when(F.col("n") > 0, 1)).alias("known2")),
        heads.select("rid", F.explode("tail_g").alias("key")).join(lm.where(F.col("n") < floor_g).select("key", F.col("lp").alias("lp1")), "key").groupBy("rid").agg(F.sum("lp1").alias("lp2")),
    ]
    joined = heads.drop("tail_w", "tail_g").join(tails[0], "rid", "left").join(tails[1], "rid", "left")
    lp = F.col("lp") + F.coalesce("lp2", F.lit(0.0))
    return joined.select(F.col("k").alias(key), held_out(F.col("k"), mod, rest).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known2", F.lit(0))).alias("n_known"), F.lit(n_all).cast("bigint").alias("train_tokens"), (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"), lp.alias("score"), (-lp / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"))
