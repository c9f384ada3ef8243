"""Byte-level BPE: encode and decode whole texts by a file of ranks.

Distinct pieces are put into padded numpy matrices by length. In each round every row merges its leftmost pair of least
rank, found through a hashed table of pairs; rows that have no pair left are taken out. A piece longer than the widest
matrix is merged with a heap instead, in the same order, as a matrix would cost the square of its length.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .runtime import HashTable, lean

_NONE = np.int32(2**31 - 1)
#: Longest piece, in bytes, that is merged in a matrix.
WIDEST = 256
#: Pieces, and words with what touches them, whose ids a worker remembers, and their greatest length; those last used go last.
REMEMBERED, REMEMBERED_LENGTH = 100_000, 64
#: Bytes of rows that are encoded at once.
BATCH = 4 << 20
#: Words whose pieces are held at once, and cells of a matrix.
AT_ONCE, CELLS = 1 << 15, 1 << 17
#: The usual pattern of byte-level vocabularies.
CUT_AT_SPACES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Bpe:
    """A vocabulary of ranks. File lines: the token's bytes in base64, a space, its rank."""

    def __init__(self, path: str, pattern: str, most: int = REMEMBERED):
        """most: entries that a memo takes before it ages."""
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        self.pattern = regex.compile(pattern)
        self.token = {v: k for k, v in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        keys, made = [], []
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(r)
        self.pairs, self.made = HashTable(np.array(keys, np.int64)), np.array([*made, _NONE], np.int32)
        #: In the usual pattern a space between two other characters always begins a piece: texts are cut there.
        self.cuts = pattern == CUT_AT_SPACES
        self.most = most
        self.chunks: list[dict] = [{}, {}, {}]
        self.pieces: list[dict] = [{}, {}, {}]

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank that joining ids a and b has; _NONE if they don't join or one is padding (negative)."""
        r = self.made[self.pairs.find(a.astype(np.int64) << 32 | np.maximum(b, 0))]
        return np.where((a < 0) | (b < 0), _NONE, r)

    def merge_matrix(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces of about one length, as little-endian 32-bit integers."""
        width = max(map(len, pieces))
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        lens = np.array([len(p) for p in pieces])
        filled = np.arange(width) < lens[:, None]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[filled] = self.single[flat]
        ranks = self.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), width - 1)
        made, rows = np.full(ids.shape, -1, np.int32), np.arange(len(pieces))
        while len(rows):
            j = ranks.argmin(1)  # the first of equal ones: leftmost
            at = np.arange(len(rows))
            least = ranks[at, j]
            go = least != _NONE
            if not go.all():
                made[rows[~go], : ids.shape[1]] = ids[~go]
                rows, ids, ranks, j, least = rows[go], ids[go], ranks[go], j[go], least[go]
                if not len(rows):
                    break
                at = np.arange(len(rows))
            w = ids.shape[1]
            ids[at, j] = least
            right = np.arange(1, w) > (j + 1)[:, None]  # what moves one place left
            ids[:, 1:-1] = np.where(right[:, :-1] | (np.arange(1, w - 1) == (j + 1)[:, None]), ids[:, 2:], ids[:, 1:-1])
            ids[:, -1] = -1
            if w > 2:
                ranks[:, :-1] = np.where(np.arange(w - 2) > j[:, None], ranks[:, 1:], ranks[:, :-1])
                ids, ranks = ids[:, :-1], ranks[:, :-1]  # each row has become one shorter
            for k in (j - 1, j):  # the pairs beside the merged token
                ok = np.flatnonzero((k >= 0) & (k < ids.shape[1] - 1))
                r, c = at[ok], k[ok]
                ranks[r, c] = self.rank_of(ids[r, c], ids[r, c + 1])
            if w == 2:
                ranks[:] = _NONE
        kept = made >= 0
        flat, ends = made[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(1)) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def merge_long(self, piece: bytes) -> bytes:
        """The same for one long piece, with a heap of pairs by rank and place."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = [*range(1, n), -1], [*range(-1, n - 1)], [True] * n
        a = np.array(ids, np.int64)
        heap = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(self.rank_of(a[:-1], a[1:])) if r != _NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and (k := after[i]) >= 0 and (r := self.ranks.get(self.token[ids[i]] + self.token[ids[k]])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[k]))

        while heap:
            r, i, x, y = heapq.heappop(heap)
            k = after[i]
            if not alive[i] or k < 0 or ids[i] != x or ids[k] != y:
                continue
            ids[i], alive[k], after[i] = r, False, after[k]
            if after[k] >= 0:
                before[after[k]] = i
            push(before[i])
            push(i)
        return np.array([t for t, a in zip(ids, alive, strict=True) if a], "<u4").tobytes()

    def encode_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of distinct pieces. One that is a token as a whole is that token."""
        out: dict[str, bytes] = {}
        by: dict[int, list] = {}
        for p in pieces:
            raw = p.encode()
            if (r := self.ranks.get(raw)) is not None:
                out[p] = r.to_bytes(4, "little")
            elif (n := len(raw)) > WIDEST:
                out[p] = self.merge_long(raw)
            else:
                n = n if n < 24 else n + -n % 32
                if n in by:
                    by[n].append((p, raw))
                else:
                    by[n] = [(p, raw)]
        for k, found in by.items():
            step = max(1, CELLS // k)
            for i in range(0, len(found), step):
                part = found[i : i + step]
                out.update(zip((p for p, _ in part), self.merge_matrix([r for _, r in part]), strict=True))
        return out

    def remembered(self, keys: set[str], memo: list[dict], make) -> dict[str, bytes | None]:
        """Values of keys from two generations of a memo; make(new keys) gives those that neither has. Long keys go again at
        the next call, so that a memo is bounded in bytes."""
        young, old, long = memo
        for k in long:
            young.pop(k, None)
        if len(young) > self.most:
            young, old = {}, young
        new = keys - young.keys()
        young.update((k, old[k]) for k in new & old.keys())
        young.update(make(new - old.keys()))
        memo[:] = young, old, {k: None for k in new if len(k) > REMEMBERED_LENGTH}
        return young

    def encode_chunks(self, chunks: set[str]) -> dict[str, bytes | None]:
        """Ids of a space and what follows it up to the next; None if white space touches either end of that."""
        find, out, todo = self.pattern.findall, {}, iter(chunks)
        while part := list(islice(todo, AT_ONCE)):
            one: dict[str, str] = {}
            split = {c: None if not c or c[0].isspace() or c[-1].isspace() else tuple([one.setdefault(p, p) for p in find(f" {c}")]) for c in part}
            ids = self.encode_pieces(one.keys())
            out.update((c, None if s is None else ids[s[0]] if len(s) == 1 else b"".join([ids[p] for p in s])) for c, s in split.items())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers. Texts are split once to gather what is new and once more to
        join, so that the words of one text are held at a time, and each piece of all texts once."""
        chunks: set[str] = set()
        if self.cuts:
            for t in texts:
                chunks.update(t.split(" ")[1:])
        ids = self.remembered(chunks, self.chunks, self.encode_chunks)
        del chunks
        tails: list[bytes] = []
        heads: list[list[str]] = []
        find, one = self.pattern.findall, {}
        for t in texts:
            s = t.split(" ") if self.cuts else [t]
            rest = [ids[c] for c in s[1:]]
            whole = not self.cuts or None in rest or s[0] and s[0][-1].isspace() or not s[0] and rest
            tails.append(b"" if whole else b"".join(rest))
            heads.append([one.setdefault(p, p) for p in find(t if whole else s[0])])
        ids = self.remembered(one.keys(), self.pieces, self.encode_pieces)
        return [b"".join([ids[p] for p in w]) + o for w, o in zip(heads, tails, strict=True)]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ids stand for."""
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def _loaded(path: str, pattern: str, most: int = REMEMBERED) -> Bpe:
    return Bpe(path, pattern, most)


def _batches(batch: pa.RecordBatch, most: int = BATCH) -> Iterator[tuple[pa.Array, list]]:
    """Ids and values of runs of rows of bounded size."""
    n, step = batch.num_rows, max(1, int(batch.num_rows * most / max(1, batch.nbytes)))
    for i in range(0, n, step):
        part = batch.slice(i, step)
        yield part.column(0), part.column(1).to_pylist()


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", key: str = "doc_id", decoded: bool = False, at_once: int = BATCH, remembered: int = REMEMBERED) -> DataFrame:
    """key, token_ids (binary: little-endian unsigned 32-bit integers), n_tokens; a row for each row of docs. With decoded
    there is also what the ids decode to, made in the same pass, so that a task holds the vocabulary once.

    Null and empty texts have no tokens. Null and repeated keys stay as they are; other columns of docs are not read.
    ranks_path is opened on each executor, as vocabularies are installed there with the library. Fewer bytes at_once and
    entries remembered take less memory in a worker and more time; the ids are the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(ranks_path, pattern, remembered)
        for batch in batches:
            for keys, texts in _batches(batch, at_once):
                ids = bpe.encode([t or "" for t in texts])
                back = [pa.array([bpe.decode(x) for x in ids], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64()), *back], ["k", "token_ids", "n_tokens", "decoded"][: 3 + decoded])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t")).mapInArrow(lean(run), f"k {kind}, token_ids binary, n_tokens bigint" + ", decoded binary" * decoded)
    return out.withColumnRenamed("k", key)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """The encoded rows with decoded (binary), the bytes of their token_ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(ranks_path, pattern)
        for batch in batches:
            names = batch.schema.names
            at = names.index("token_ids")
            for i in range(0, batch.num_rows, step := max(1, int(batch.num_rows * (4 << 20) / max(1, batch.nbytes)))):
                part = batch.slice(i, step)
                made = pa.array([bpe.decode(x or b"") for x in part.column(at).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*names, "decoded"])

    plain = encoded.drop("decoded")
    return plain.mapInArrow(lean(run), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema) + ", decoded binary")


def oracle(ranks_path: str) -> str:
    """SQL for digests of documents' ids and decoded bytes under the usual pattern: each distinct piece merges its leftmost
    pair of least rank, step by step. SQL's patterns can't look ahead, so texts are cut first where white space of two
    characters and more gives its last one to what follows. Tokens go as hexadecimal digits."""
    space = "\\t-\\r \\x{85}\\p{Z}"
    pattern = f"''s|''t|''re|''ve|''m|''ll|''d| ?\\p{{L}}+| ?\\p{{N}}+| ?[^{space}\\p{{L}}\\p{{N}}]+|[{space}]+"
    little = "lpad(to_hex(rank & 255), 2, '0') || lpad(to_hex(rank >> 8 & 255), 2, '0') || lpad(to_hex(rank >> 16 & 255), 2, '0') || lpad(to_hex(rank >> 24 & 255), 2, '0')"
    return f"""WITH RECURSIVE v AS (SELECT hex(from_base64(b)) AS tok, rank FROM read_csv('{ranks_path}', delim = ' ', header = false, quote = '', escape = '', auto_detect = false, columns = {{'b': 'VARCHAR', 'rank': 'BIGINT'}})),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
c AS (SELECT r, unnest(string_split(cut, chr(57344))) AS c, generate_subscripts(string_split(cut, chr(57344)), 1) AS j FROM (SELECT r, regexp_replace(t, '([{space}]+)([{space}][^{space}])', '\\1' || chr(57344) || '\\2', 'g') AS cut FROM d)),
p AS (SELECT r, j, unnest(ps) AS p, generate_subscripts(ps, 1) AS i FROM (SELECT r, j, regexp_extract_all(c, '{pattern}') AS ps FROM c)),
u AS (SELECT DISTINCT p, hex(encode(p)) AS h FROM p),
m AS (
  SELECT p, 0 AS step, CASE WHEN h IN (SELECT tok FROM v) THEN [h] ELSE list_transform(generate_series(1, length(h) // 2), lambda i: substring(h, 2 * i - 1, 2)) END AS toks FROM u
  UNION ALL
  SELECT p, step + 1, list_concat(list_concat(toks[:pos - 1], [toks[pos] || toks[pos + 1]]), toks[pos + 2:]) FROM (
    SELECT p, any_value(step) AS step, any_value(toks) AS toks, arg_min(pos, rank * 4294967296 + pos) AS pos FROM (
      SELECT p, step, toks, pos, v.rank FROM (SELECT p, step, toks, unnest(generate_series(1, len(toks) - 1)) AS pos FROM m WHERE len(toks) > 1) x JOIN v ON v.tok = toks[pos] || toks[pos + 1]) GROUP BY p)),
l AS (SELECT p, arg_max(toks, step) AS toks FROM m GROUP BY p),
e AS (SELECT p, count(*) AS n, string_agg({little}, '' ORDER BY i) AS ids, string_agg(tok, '' ORDER BY i) AS raw FROM (SELECT p, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM l) JOIN v USING (tok) GROUP BY p),
o AS (SELECT r, sum(n)::BIGINT AS n_tokens, string_agg(ids, '' ORDER BY j, i) AS ids, string_agg(raw, '' ORDER BY j, i) AS raw FROM p JOIN e USING (p) GROUP BY r)
SELECT doc_id, coalesce(n_tokens, 0)::BIGINT AS n_tokens, sha256(unhex(coalesce(ids, ''))) AS ids_sha256, sha256(unhex(coalesce(raw, ''))) AS decoded_sha256 FROM d LEFT JOIN o USING (r)"""
