"""Benchmark decontamination: a prefix-filtered set join of document words with windows of benchmark items.

A window is a run of consecutive item words (or the whole item, if shorter); it occurs where a document has the same
words in a row. For exact containment the prefix that must be joined is one shingle a window: its rarest one, by how often
documents have it. So

1. the shingles of all windows are counted over all documents;
2. each window is filed under its rarest shingle, with that shingle's offset in the window;
3. each document word that begins a filed shingle proposes windows at (place - offset); the positional bound drops places
   before the text's start, the length bound those beyond its end;
4. the words of a proposed place are compared with all of the window's.

Windows and shingles are arrays, built once on the driver and looked up for a whole pass of text at a time. The benchmark is
sent to the tasks in blocks of at most BLOCK_BYTES of item text; a larger one takes several rounds over the documents,
each adding to what the rounds before found. Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import LOWER, WORDLIKE, HashTable, discard, hashed_words, lean, materialize, mix, passes, utf8

#: Item words of a window.
WINDOW = 10
#: Words of a shingle.
SHINGLE = 3
#: Bytes of item text that are broadcast at once.
BLOCK_BYTES = 8 << 20

#: Turns text bytes to lower case and all that is in no word to a space.
_CLEAN = bytes(int(LOWER[b]) if WORDLIKE[LOWER[b]] else 32 for b in range(256))
_STATE = "hit binary, items array<{kind}>, n_words bigint"


def words_of(text: str | None) -> list[bytes]:
    """The words of a whole text: runs of ASCII letters, digits and anything beyond ASCII, A-Z in lower case."""
    return text.encode().translate(_CLEAN).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """All windows of an item's words."""
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def _joined(h: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` words from each place on."""
    out = np.full(len(at), size, np.uint64)
    for j in range(size):
        out = mix(out * np.uint64(3) + h[at + j])
    return out.view(np.int64)


class Windows:
    """The distinct windows of a block of items, as arrays: it is built once, on the driver, and broadcast.

    A window is a stretch of the items' words. It has a hash of all its words and one for each of its shingles; shingles
    are numbered through.
    """

    def __init__(self, items: list[tuple[object, str]], size: int = WINDOW, shingle: int = SHINGLE):
        raw = [(t or "").encode() for _, t in items]
        self.text = LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        starts, ends, h, wb = hashed_words(self.text, np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64), WORDLIKE)
        self.starts, self.ends = starts.astype(np.int32), ends.astype(np.int32)
        n = np.diff(wb)
        count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
        item = np.repeat(np.arange(len(n)), count)
        first = wb[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
        length = np.minimum(n[item], size)
        hashes = np.zeros(len(item), np.int64)
        for k in np.unique(length):
            hashes[length == k] = _joined(h, first[length == k], int(k))
        order = np.lexsort((item, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        self.first, self.length, self.hash = first[order][new].astype(np.int32), length[order][new].astype(np.int32), hashes[order][new]
        # the items of each window, by their place among the distinct ids
        self.ids = list(dict.fromkeys(k for k, _ in items if k is not None))
        place = {k: i for i, k in enumerate(self.ids)}
        owner = np.array([place.get(k, -1) for k, _ in items], np.int64)[item[order]] if items else np.zeros(0, np.int64)
        pair = np.unique(np.stack([np.cumsum(new) - 1, owner], 1)[owner >= 0], axis=0).reshape(-1, 2)
        self.owner, self.owners = pair[:, 1].astype(np.int32), np.searchsorted(pair[:, 0], np.arange(len(self.first) + 1)).astype(np.int32)
        # shingles of the words of the items; an item of fewer words is one shingle of its own length
        self.sizes: list[tuple[int, HashTable]] = []
        self.shingles: list[tuple[np.ndarray, np.ndarray]] = []  # of each size its windows, and the number of each word's shingle
        for k in range(1, shingle + 1):
            own = np.flatnonzero(np.minimum(self.length, shingle) == k)
            if len(own):
                at = _places(wb, k) if k == shingle else self.first[own]
                names, number = np.unique(_joined(h, at, k), return_inverse=True)
                of = np.zeros(len(h), np.int32)
                of[at] = number
                self.sizes.append((k, HashTable(names)))
                self.shingles.append((own, of))

    def __getstate__(self) -> dict:
        """What tasks need: not what windows are filed by."""
        return {k: v for k, v in self.__dict__.items() if k != "shingles"}

    def file(self, counts: list[np.ndarray]) -> None:
        """File each window under the rarest of its shingles, the first of equal ones. counts: of each size's shingles."""
        self.filed = []
        for (k, table), (own, number), n in zip(self.sizes, self.shingles, counts, strict=True):
            first, last = self.first[own], self.length[own] - k
            offset, under = np.zeros(len(own), np.int32), number[first]
            for j in range(1, int(last.max()) + 1):
                other = number[first + np.minimum(j, last)]
                better = n[other] < n[under]
                offset[better], under[better] = j, other[better]
            order = np.argsort(under, kind="stable")
            self.filed.append((k, table, own[order].astype(np.int32), offset[order], np.searchsorted(under[order], np.arange(len(table.keys) + 1)).astype(np.int32)))

    def count(self, h: np.ndarray, wb: np.ndarray) -> list[np.ndarray]:
        """How often rows of words have each shingle, by size."""
        out = []
        for k, table in self.sizes:
            at = table.find(_joined(h, _places(wb, k), k))
            out.append(np.bincount(at[at >= 0], minlength=len(table.keys)))
        return out

    def find(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, wb: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where windows occur in rows of words: first word, window, row."""
        found = [np.zeros((0, 3), np.int64)]
        for k, table, windows, offsets, bounds in self.filed:
            at = _places(wb, k)
            under = table.find(_joined(h, at, k))
            at, under = at[under >= 0], under[under >= 0]
            n = bounds[under + 1] - bounds[under]
            pick = np.repeat(bounds[under] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            window, first = windows[pick], np.repeat(at, n) - offsets[pick]
            row = np.searchsorted(wb, np.repeat(at, n), "right") - 1
            fits = (first >= wb[row]) & (first + self.length[window] <= wb[row + 1])  # positional and length bounds
            window, first, row = window[fits], first[fits], row[fits]
            same = np.zeros(len(first), bool)
            for size in np.unique(self.length[window]):
                some = np.flatnonzero(self.length[window] == size)
                same[some] = _joined(h, first[some], int(size)) == self.hash[window[some]]
            for i in np.flatnonzero(same):  # the words themselves
                a, b, size = first[i], self.first[window[i]], int(self.length[window[i]])
                same[i] = all(text[starts[a + j] : ends[a + j]].tobytes() == self.text[self.starts[b + j] : self.ends[b + j]].tobytes() for j in (range(size)))
            found.append(np.stack([first[same], window[same], row[same]], 1))
        return tuple(np.concatenate(found).T)


def _places(wb: np.ndarray, size: int) -> np.ndarray:
    """The words from which on `size` words of the same row follow."""
    n = np.maximum(np.diff(wb) - size + 1, 0)
    return np.repeat(wb[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())


def blocks(items: DataFrame, item: str, text: str, most: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str]]]:
    """The items' ids and texts, about `most` bytes of text at a time."""
    part: list[tuple[object, str]] = []
    size = 0
    for row in items.select(item, text).where(F.col(text).isNotNull()).toLocalIterator():
        part.append((row[0], row[1]))
        size += len(row[1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _or_empty(parts: Iterator[list]) -> Iterator[list]:
    """The parts, or one that is empty."""
    none = True
    for p in parts:
        none = False
        yield p
    if none:
        yield []


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, keep: tuple[str, ...] = ()) -> DataFrame:
    """For each row of docs: key, n_words, hit (a byte for each word, 1 in an occurrence; null if none is hit), items (the
    distinct ids of items with an occurring window, unordered; null ids are left out), and the columns of docs in keep.

    Null and empty texts have no words and no hits. Items without words have no windows. Repeated rows of docs are judged
    one by one; repeated items count as one item for each distinct id.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType.simpleString()
    kinds = f"t string, r struct<k:{docs.schema[key].dataType.simpleString()}{''.join(f',x{i}:{docs.schema[c].dataType.simpleString()}' for i, c in enumerate(keep))}>"
    state = docs.select(docs[text].cast("string").alias("t"), F.struct(docs[key].alias("k"), *[docs[c].alias(f"x{i}") for i, c in enumerate(keep)]).alias("r"), F.lit(None).cast("binary").alias("hit"), F.lit(None).cast(f"array<{kind}>").alias("items"), F.lit(0).cast("bigint").alias("n_words"))
    texts = docs.select(docs[text].cast("string").alias("t"))
    before: DataFrame | None = None
    for k, block in enumerate(_or_empty(blocks(items, item, item_text, block_bytes))):
        if k:  # each round's Python ends before the next one's begins
            state = materialize(state, "overlaps")
            if before is not None:
                discard(before)
            before = state
        windows = Windows(block)
        sent = spark.sparkContext.broadcast(windows)  # some 12 times the block's bytes

        def count(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            counts = [np.zeros(len(x[1].keys), np.int64) for x in sent.value.sizes]
            for batch in batches:
                for _, _, part, o in passes(*utf8(batch.column(0))):
                    _, _, h, wb = hashed_words(LOWER[part], o, WORDLIKE)
                    for total, n in zip(counts, sent.value.count(h, wb), strict=True):
                        total += n
            for size, n in enumerate(counts):
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), size, np.int32)), pa.array(some), pa.array(n[some])], ["size", "s", "n"])

        counted = texts.mapInArrow(lean(count), "size int, s bigint, n bigint").groupBy("size", "s").agg(F.sum("n").alias("n")).toArrow()
        counts = [np.zeros(len(x[1].keys), np.int64) for x in windows.sizes]  # bounded: no more rows than the block has shingles
        size, s, n = (counted.column(c).to_numpy() for c in ("size", "s", "n"))
        for i, c in enumerate(counts):
            c[s[size == i]] = n[size == i]
        windows.file(counts)
        rare = spark.sparkContext.broadcast(windows)

        def find(batches: Iterator[pa.RecordBatch], rare=rare) -> Iterator[pa.RecordBatch]:
            index = rare.value
            for batch in batches:
                for a, b, part, o in passes(*utf8(batch.column(0))):
                    text = LOWER[part]
                    starts, ends, h, wb = hashed_words(text, o, WORDLIKE)
                    first, window, row = index.find(text, starts, ends, h, wb)
                    steps = np.bincount(first, minlength=len(h) + 1) - np.bincount(first + index.length[window], minlength=len(h) + 1)
                    hit = np.cumsum(steps)[:-1] > 0
                    n = index.owners[window + 1] - index.owners[window]
                    pick = np.repeat(index.owners[window] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    pairs = np.unique(np.stack([np.repeat(row, n), index.owner[pick]], 1), axis=0)
                    bounds = np.searchsorted(pairs[:, 0], np.arange(b - a + 1))
                    hits, found = [], []
                    for i, (old, had) in enumerate(zip(batch.column(2).slice(a, b - a).to_pylist(), batch.column(3).slice(a, b - a).to_pylist(), strict=True)):
                        now = hit[wb[i] : wb[i + 1]]
                        if old:
                            now = now | (np.frombuffer(old, np.uint8) > 0)
                        hits.append(now.astype(np.uint8).tobytes() if now.any() else None)
                        ids = {index.ids[x] for x in pairs[bounds[i] : bounds[i + 1], 1]} | set(had or [])
                        found.append(list(ids) or None)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(hits, pa.binary()), pa.array(found, batch.schema.field(3).type), pa.array(np.diff(wb))], ["t", "r", "hit", "items", "n_words"])

        state = state.mapInArrow(lean(find), f"{kinds}, {_STATE.format(kind=kind)}")
    return state.select(F.col("r.k").alias(key), "n_words", "hit", "items", *[F.col(f"r.x{i}").alias(c) for i, c in enumerate(keep)])


def report(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated of what overlaps() returns."""
    ids = F.array_sort(F.transform(F.coalesce("items", F.array().cast(found.schema["items"].dataType)), lambda x: x.cast("string")))
    n_hit = F.coalesce(F.length(F.regexp_replace(F.decode("hit", "ISO-8859-1"), "\\x00", "")), F.lit(0)).cast("bigint")
    return found.select(key, "n_words", n_hit.alias("n_hit"), F.size(ids).cast("bigint").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def digest(items: list[object]) -> str:
    """items_sha256 of some ids, in plain Python, for tests."""
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def spans_of(hit: bytes | None) -> list[tuple[int, int]]:
    """The runs of hit words as (start, end)."""
    out, at = [], 0
    for one, run in groupby(hit or b""):
        n = len(list(run))
        if one:
            out.append((at, at + n))
        at += n
    return out


ORACLE = """
WITH i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, list_slice(w, p, p + least(len(w), 10) - 1) AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS p FROM i WHERE len(w) > 0)),
n AS (SELECT DISTINCT len(win) AS n FROM iw),
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
dw AS (SELECT r, n, p, list_slice(w, p, p + n - 1) AS win FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p FROM d, n WHERE len(w) >= n)),
m AS (SELECT r, n, p, item_id FROM dw JOIN iw USING (win)),
h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(p, p + n - 1)) AS at FROM m) GROUP BY r),
o AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN o USING (r)
"""
