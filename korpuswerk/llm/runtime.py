"""What the operators share: tables in the shared folder, text columns as numpy arrays, word tokens and hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Where tables go if the session names no folder and runs on one machine, as in tests.
OWN_FOLDER = "/tmp/checkpoints"
#: Bytes of text that one numpy pass holds at once. A longer text is a pass of its own, whose words are hashed in runs.
PASS_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one where that is unset and the session
    is local. On a cluster a local folder would be another one on each machine: ValueError."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (folder or f"file://{OWN_FOLDER}").rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._korpuswerk_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_korpuswerk_path", None)
    if path:
        jvm, jsc = df.sparkSession._jvm, df.sparkSession.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, giving back what it has freed to the system when a task ends: workers live on from stage to stage."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # only glibc has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, null as empty, and the rows' n + 1 offsets into them."""
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        col = pc.fill_null(col, "" if not pa.types.is_binary(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    if data is None or o[-1] == o[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[o[0] : o[-1]], o - o[0]


def passes(data: np.ndarray, offs: np.ndarray, most: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about `most` bytes: first row, end row, their bytes and offsets."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = min(n, max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1))
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table that is True at the given inclusive spans of byte values."""
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a : b + 1] = True
    return out


#: Maps A-Z to a-z and leaves all other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words that are runs of anything but white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of words that are runs of letters, digits and all beyond ASCII (capitals are lower-cased first).
WORDLIKE = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def words(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of table's bytes within rows, and each row's n + 1 bounds among them. Works in
    slices, so that a long text costs little beside its words."""
    starts, ends = [], []
    for a in range(0, len(data), PASS_BYTES):
        b = min(a + PASS_BYTES, len(data))
        m = table[data[max(a - 1, 0) : b + 1]]  # with a neighbour on either side, if there is one
        lead, n = min(a, 1), b - a
        mine = m[lead : lead + n]
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = mine[:-1], mine[1:]
        before[0], after[-1] = bool(lead) and m[0], len(m) > lead + n and m[-1]
        inner = offs[np.searchsorted(offs, a) : np.searchsorted(offs, b)] - a
        before[inner] = False
        inner = offs[np.searchsorted(offs, a, "right") : np.searchsorted(offs, b, "right")] - a
        after[inner - 1] = False
        starts.append(np.flatnonzero(mine & ~before) + a)
        ends.append(np.flatnonzero(mine & ~after) + a + 1)
    if not starts:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    s = np.concatenate(starts)
    return s, np.concatenate(ends), np.searchsorted(s, offs)


def hashed_words(data: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words() with a 64-bit hash of each: starts, ends, hashes, bounds. Hashed in runs of words of bounded size."""
    s, e, wb = words(data, offs, table)
    out, i = np.empty(len(s), np.uint64), 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + PASS_BYTES, "right")))
        out[i:j] = Hasher(data[s[i] : e[j - 1]])(s[i:j] - s[i], e[i:j] - s[i])
        i = j
    return s, e, out, wb


_M = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 to the 64."""
    up, down = _POWERS.get("up", ()), _POWERS.get("down", ())
    if len(up) < n:
        up, down = (np.cumprod(np.append(np.uint64(1), np.full(max(n, PASS_BYTES + 1) - 1, x, np.uint64)), dtype=np.uint64) for x in (_M, pow(_M, -1, 1 << 64)))
        if n <= PASS_BYTES + 1:  # what a word of over a pass needs isn't kept
            _POWERS.update(up=up, down=down)
    return up[:n], down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """64-bit hashes of any stretches of a byte array, from prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(56)))


class HashTable:
    """Fixed map from int64 keys (none negative) to positions 0..n-1, open addressing; lookups are whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 2).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.ascontiguousarray(keys, np.int64)
        left, at = np.arange(len(keys), dtype=np.int32), self._home(self.keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # of several, the last one stays
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(_M)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' positions, -1 where absent."""
        out = np.full(len(keys), -1, np.int32)
        if not len(self.keys) or not len(keys):
            return out
        at = self._home(keys)
        s = self.slots[at]
        hit = (s >= 0) & (self.keys[s] == keys)
        out[hit] = s[hit]
        todo = np.flatnonzero((s >= 0) & ~hit)
        at = at[todo]
        while len(todo):
            at = (at + 1) & ((1 << self.bits) - 1)
            s = self.slots[at]
            hit = (s >= 0) & (self.keys[s] == keys[todo])
            out[todo[hit]] = s[hit]
            go = (s >= 0) & ~hit
            todo, at = todo[go], at[go]
        return out
