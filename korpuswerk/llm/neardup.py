"""SimHash near-dedup with a verified similarity: one document of each group stays.

A document is a set of hashed shingles of SIZE words, with a SimHash fingerprint of 64 bits. Documents with equal sets are
one. Shards are named by pairs of least hashes of the set under KEYS pairs of hash functions: two sets of similarity 0.8
meet in a shard but for a chance of (1 - 0.8 ** 2) ** 16, some 8 in 100 million, more similar ones more surely. A shard's
task goes through its members in their order with a BK-tree of the fingerprints that lead so far: a member asks it along
the edges within RADIUS, compares its set exactly with those that are found, and leads too if none is similar. What leaves
a shard is at most one link a member, from its leader, never the pairs of a group; what a task holds are leaders.

Documents that lead wherever they are stay. Those that have a link from one that stays go. What is left (it has links only
from documents that don't stay) goes through the shards again, behind those that stay. So no two that stay are similar,
and each that goes is similar to one that stays and comes before it.

A shard of more than CHUNK members is dealt in chunks first, by a hash of the member. What leads in a chunk is dealt to
further shards by the next hash functions, so that large groups of copies have shrunk to a few leaders by then, and many
different documents with a passage in common part.

Sets of similarity 0.8 differ in 9.7 bits on average, and in more than the radius of 24 in some 3 of a million cases (in 1
of 8,000 where they have only four and five shingles). It is too wide for blocks of bits to be shard names, as op7's three
bits have.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import NOT_SPACE, discard, hashed_words, lean, materialize, mix, passes, utf8
from .simhash import BkTree

SIZE = 5
LEAST = 0.8
RADIUS = 24
KEYS, CHUNK, LEVELS = 16, 2048, 4
_EMPTY = np.uint64(0x5EED)


def _shingles(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all rows the distinct shingles' hashes, sorted within a row, and each row's n + 1 bounds among them."""
    rows = len(offs) - 1
    _, _, h, wb = hashed_words(data, offs, NOT_SPACE)
    n = np.diff(wb)
    count = np.maximum(n - size + 1, 1)
    row = np.repeat(np.arange(rows), count)
    begin = wb[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    long, out = n[row] >= size, np.full(len(row), _EMPTY)
    h = np.append(h, np.uint64(0))  # so that a place behind the last word can be read
    with np.errstate(over="ignore"):
        for j in range(size):
            there = np.flatnonzero(long | (j < n[row]))
            out[there] = mix(out[there] * np.uint64(3) + h[begin[there] + j])
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    row, out = row[first], out[first]
    return out, np.searchsorted(row, np.arange(rows + 1))


def _fingerprints(hs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each row's set the bits that are set in over half of its members."""
    out = np.zeros(len(bounds) - 1, np.uint64)
    n = np.diff(bounds)
    for b in range(64):
        ones = np.concatenate([[0], np.cumsum((hs >> np.uint64(b)) & np.uint64(1), dtype=np.int64)])
        out |= (2 * np.diff(ones[bounds]) > n).astype(np.uint64) << np.uint64(b)
    return out


def _keys(hs: np.ndarray, starts: np.ndarray, level: int) -> np.ndarray:
    """Shard names of sets that begin at starts: a row of KEYS numbers for each. Every level has hash functions of its own."""
    odd = np.random.default_rng([29, level]).integers(1, 1 << 63, 2 * KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.stack([np.minimum.reduceat(mix(hs * a), starts) for a in odd], 1)
    return mix(least[:, ::2] * np.uint64(3) + mix(least[:, 1::2]) + np.arange(KEYS, dtype=np.uint64)).view(np.int64)


def _named(col: pa.Array, size: int) -> Iterator[tuple[int, int, list[bytes], np.ndarray, np.ndarray]]:
    """Runs of rows of a text column: their first and end row, names (128-bit hashes of their sets), sets and bounds."""
    data, offs = utf8(col)
    for a, b, part, o in passes(data, offs, 1 << 20):
        hs, bounds = _shingles(part, o, size)
        yield a, b, [blake2b(hs[x:y].tobytes(), digest_size=16).digest() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], hs, bounds


def _describe(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, names, hs, bounds in _named(batch.column(2), size):
            keys = _keys(hs, bounds[:-1], 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, KEYS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(names, pa.binary()), pa.array(_fingerprints(hs, bounds).view(np.int64)), lists], ["k", "th", "s", "fp", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, names, hs, bounds in _named(batch.column(0), size):
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([hs[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["s", "hs"])


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least `least`."""
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both >= least * (len(a) + len(b) - both) - 1e-9


class Leaders:
    """Members of a shard that no one before is similar to."""

    def __init__(self, least: float, radius: int):
        self.least, self.tree, self.names, self.sets = least, BkTree(radius), [], []

    def ask(self, name: bytes, fp: int, hs: np.ndarray, stays: bool) -> bytes | None:
        """The first leader that is similar; without one the member leads too. One that stays isn't compared."""
        if not stays:
            for i in sorted(self.tree.near(fp)):
                if similar(self.sets[i], hs, self.least):
                    return self.names[i]
        self.tree.insert(fp)
        self.names.append(name)
        self.sets.append(hs)
        return None


def _lead(batches: Iterator[pa.RecordBatch], least: float, radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (key, chunk, s, fp, hs, stays) sorted by shard, chunk and order; one shard's leaders are held at a time."""
    now, leaders = None, Leaders(least, radius)
    for batch in batches:
        key, chunk, s, fp = (batch.column(i).to_pylist() for i in range(4))
        stays, by = batch.column(5).to_pylist(), []
        for i in range(len(s)):
            if (key[i], chunk[i]) != now:
                now, leaders = (key[i], chunk[i]), Leaders(least, radius)
            by.append(leaders.ask(s[i], fp[i] & (1 << 64) - 1, np.frombuffer(batch.column(4)[i].as_py(), np.uint64), stays[i]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(by, pa.binary())], ["key", "s", "by"])


def _deeper(batches: Iterator[pa.RecordBatch], level: int) -> Iterator[pa.RecordBatch]:
    """(key, s) of further shards, named by the old one and by the level's hash functions."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offs = utf8(batch.column(2))
        keys = _keys(np.frombuffer(raw.tobytes(), np.uint64), offs[:-1] // 8, level)
        old = batch.column(0).to_numpy().view(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(mix(old[:, None] * np.uint64(3) + keys.view(np.uint64)).view(np.int64).ravel()), batch.column(1).take(pa.array(np.repeat(np.arange(batch.num_rows), KEYS)))], ["key", "s"])


def _shared(dealt: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, n) of shards with two members and more; of several with the same members only one."""
    mark = F.xxhash64(F.lit(7), "s").cast("decimal(20,0)")
    groups = dealt.groupBy("key").agg(F.count("*").alias("n"), F.sum(mark).alias("x"), F.sum(F.hash("s").cast("bigint")).alias("y")).where("n > 1")
    return groups.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))


def _members(dealt: DataFrame, chunk: int) -> DataFrame:
    """(key, parts, s): the members of shared shards, written, and in how many chunks a shard goes."""
    return materialize(dealt.join(_shared(dealt, chunk), "key").select("key", "parts", "s"), "members")


def _links(members: DataFrame, kinds: DataFrame, sets: DataFrame, state: DataFrame, least: float, radius: int, chunk: int) -> DataFrame:
    """(by, s), written: links from leaders. state: (s, stays) of the documents that take part. members: the first level's
    shards."""
    out, used = None, []
    for level in range(1, LEVELS + 1):
        last = level == LEVELS
        parts = F.lit(1) if last else F.col("parts")
        rows = members.join(state, "s").join(sets, "s").join(kinds.select("s", "first", "fp"), "s").withColumn("chunk", F.pmod(F.xxhash64("s"), parts).cast("int"))
        rows = rows.select("key", "chunk", "s", "fp", "hs", "stays", "first", "parts")
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ordered = rows.repartition(n, "key", "chunk").sortWithinPartitions("key", "chunk", F.desc("stays"), "first").select("key", "chunk", "s", "fp", "hs", "stays")
        led = materialize(ordered.mapInArrow(lean(lambda b: _lead(b, least, radius)), "key bigint, s binary, by binary"), "led")
        found = led.where("by IS NOT NULL").select("by", "s")
        out = found if out is None else out.union(found)
        used.append(led)
        large = members.where("parts > 1").select("key").distinct()
        if last or large.isEmpty():
            break
        # those that lead in a chunk of a large shard meet by further hash functions
        rest = led.where("by IS NULL").join(large, "key", "left_semi").join(sets, "s").select("key", "s", "hs")
        deeper = materialize(rest.mapInArrow(lean(lambda b, level=level: _deeper(b, level)), "key bigint, s binary"), "deeper")
        members = _members(deeper, chunk)
        used += [deeper, members]
    out = materialize(out.distinct(), "links")
    for t in used:
        discard(t)
    return out


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, least: float = LEAST, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """docs without those that are similar to one that stays, in the order of keys (null last) and then hashes of the text.

    Words are lower-cased and parted by ASCII white space. A text of fewer than `size` words is one shingle. Null,
    empty and blank texts are equal. Rows that repeat both key and text are one document and stay together. Columns are
    those of docs; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()
    named = docs.select(docs[key].alias("k"), F.xxhash64(docs[text]).alias("th"), F.lower(docs[text].cast("string")).alias("t"))
    every = materialize(named.mapInArrow(lean(lambda b: _describe(b, size)), f"k {kind}, th bigint, s binary, fp bigint, keys array<bigint>"), "described")
    order = F.struct(F.col("k").isNull().alias("z"), "k", "th")
    kinds = materialize(every.groupBy("s").agg(F.min(order).alias("first"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "kinds")
    members = _members(kinds.select(F.explode("keys").alias("key"), "s"), chunk)
    some = members.select("s").distinct().join(kinds.select("s", "first"), "s").select(F.col("first.k").alias("_k"), F.col("first.th").alias("_th"))
    # the sets themselves are made only for those that share a shard
    again = named.join(some, named["k"].eqNullSafe(some["_k"]) & (named["th"] == some["_th"]), "left_semi").select("t")
    sets = materialize(again.mapInArrow(lean(lambda b: _sets(b, size)), "s binary, hs binary").dropDuplicates(["s"]), "sets")
    state, gone, used = members.select("s", F.lit(False).alias("stays")).distinct(), [], [every, members, sets]
    while True:
        links = _links(members, kinds, sets, state, least, radius, chunk)
        covered = links.select("s").distinct()
        stay = state.join(covered, "s", "left_anti").select("s")
        out = materialize(links.join(stay.withColumnRenamed("s", "by"), "by", "left_semi").select("s").distinct(), "gone")
        gone.append(out)
        left = materialize(covered.join(out, "s", "left_anti"), "left")
        used += [links, left]
        if left.isEmpty():
            break
        state = materialize(left.select("s", F.lit(False).alias("stays")).union(stay.select("s", F.lit(True).alias("stays"))), "state")
        keys = members.join(left, "s", "left_semi").select("key").distinct()
        members = materialize(members.join(keys, "key", "left_semi").join(state, "s", "left_semi"), "members")
        used += [state, members]
    for t in used:
        discard(t)
    lost = gone[0]
    for g in gone[1:]:
        lost = lost.union(g)
    kept = kinds.join(lost, "s", "left_anti").select(F.col("first.k").alias("_k"), F.col("first.th").alias("_th"))
    return docs.join(kept, docs[key].eqNullSafe(kept["_k"]) & (F.xxhash64(docs[text]) == kept["_th"]), "left_semi")
