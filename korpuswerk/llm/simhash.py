"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked within a Hamming radius through BK-trees.

Distinct fingerprints are dealt to shards. Two of them that differ in at most 3 bits agree on one of the four 16-bit
blocks, and on one of the four quarters of what then remains; so each goes to 16 shards, and every pair in reach meets in
one. A shard's task builds its BK-tree (children keyed by their Hamming distance to the parent) and asks it for each
member, following only edges within the radius. Trees are sent to the tasks by the shuffle: gathering them for a broadcast
would bring the fingerprints of all documents to the driver. A subtree whose members all belong to the asker's group
already can't add a link and is passed over, so that a dense group costs about its size rather than its square.

What leaves a shard is a link from each linked member to its group's least one there: fewer rows than members. Groups that
meet in several shards are joined by alternating large-star and small-star steps over these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import discard, lean, materialize, passes, utf8

SHINGLE = 3
RADIUS = 3
SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(words: list[bytes], size: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' hashes; 0 without words."""
    if not words:
        return 0
    n = len(words) - size + 1
    h = xxhash.xxh64_intdigest
    if n <= 1:
        return h(b" ".join(words), SEED)
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.zeros(len(words), np.int64)
    np.cumsum(lens[:-1], out=starts[1:])
    ends = (starts + lens - 1)[size - 1 :].tolist()
    hashes = np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends, strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, fp (the fingerprint's bits as a signed long) and the columns in keep, a row for each row of docs. Null and empty
    texts have fingerprint 0."""
    cols = [docs[key].alias("k"), *[docs[c].alias(f"x{i}") for i, c in enumerate(keep)]]
    kinds = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for n, c in [("k", key), *[(f"x{i}", c) for i, c in enumerate(keep)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(batch.num_columns - 1)
            data, offs = utf8(col)
            out = np.zeros(batch.num_rows, np.uint64)
            for a, b, part, o in passes(data, offs):
                raw = part.tobytes().translate(_LOWER)
                for i in range(b - a):
                    out[a + i] = fingerprint(raw[o[i] : o[i + 1]].split())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out.view(np.int64))], [*batch.schema.names[:-1], "fp"])

    out = docs.select(*cols, docs[text].cast("string").alias("t")).mapInArrow(lean(run), f"{kinds}fp bigint")
    return out.select(F.col("k").alias(key), "fp", *[F.col(f"x{i}").alias(c) for i, c in enumerate(keep)])


class BkTree:
    """A BK-tree of integers that also keeps the groups of members within the radius of each other."""

    def __init__(self, radius: int = RADIUS):
        self.radius, self.values, self.edges, self.parent, self.one = radius, [], [], [], []

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def near(self, value: int) -> list[int]:
        """The places of all members within the radius of value."""
        out, todo = [], [0] if self.values else []
        while todo:
            i = todo.pop()
            d = (self.values[i] ^ value).bit_count()
            if d <= self.radius:
                out.append(i)
            todo += [c for e, c in self.edges[i].items() if d - self.radius <= e <= d + self.radius]
        return out

    def add(self, value: int) -> None:
        """Insert a value that isn't in the tree and join it with the groups of all members within the radius."""
        me, r, values, edges, one = len(self.values), self.radius, self.values, self.edges, self.one
        values.append(value)
        edges.append({})
        self.parent.append(me)
        one.append(True)  # whether all members below are in one group
        if not me:
            return
        todo = [0]
        while todo:
            i = todo.pop()
            same = self.root(i) == self.root(me)
            if same and one[i]:
                continue
            d = (values[i] ^ value).bit_count()
            if d <= r and not same:
                a, b = self.root(i), self.root(me)
                self.parent[a] = b
                if one[i]:
                    continue
            todo += [c for e, c in edges[i].items() if d - r <= e <= d + r]
        mine = self.root(me)
        for i in self._hang(value, me):
            if one[i] and self.root(i) != mine:
                one[i] = False

    def insert(self, value: int) -> None:
        """Insert a value that need not be new; groups are not kept."""
        me = len(self.values)
        self.values.append(value)
        self.edges.append({})
        if me:
            self._hang(value, me)

    def _hang(self, value: int, me: int) -> list[int]:
        """Hang a new place below those on the value's path; gives the path."""
        i, path = 0, []
        while True:
            path.append(i)
            d = (self.values[i] ^ value).bit_count()
            if d not in self.edges[i]:
                self.edges[i][d] = me
                return path
            i = self.edges[i][d]


def _shard_keys(fp: np.ndarray) -> np.ndarray:
    """16 keys for each fingerprint: which block and quarter, and their values."""
    out = []
    for a in range(4):
        block = (fp >> np.uint64(16 * a)) & np.uint64(0xFFFF)
        low = fp & np.uint64((1 << (16 * a)) - 1)
        rest = low | ((fp >> np.uint64(16)) & ~np.uint64((1 << (16 * a)) - 1)) if a else fp >> np.uint64(16)
        for b in range(4):
            part = (rest >> np.uint64(12 * b)) & np.uint64(0xFFF)
            out.append((np.uint64(a * 4 + b) << np.uint64(28)) | (block << np.uint64(12)) | part)
    return np.stack(out, 1)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        keys = _shard_keys(fp)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(fp, 16).view(np.int64))], ["shard", "fp"])


def shard_links(values: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links from members of groups of two and more to their group's least member, through a BK-tree."""
    tree = BkTree(radius)
    for v in values:
        tree.add(v)
    least: dict[int, int] = {}
    for i, v in enumerate(values):
        r = tree.root(i)
        least[r] = min(v, least.get(r, v))
    return [(v, m) for i, v in enumerate(values) if (m := least[tree.root(i)]) != v]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard: one tree at a time; a shard may go over several batches."""
    shard, members, out = None, [], []

    def flush() -> None:
        if len(members) > 1:
            out.extend(shard_links(members))

    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        sizes = np.diff(bounds)
        for j in range(len(sizes)):
            a, b = bounds[j], bounds[j + 1]
            if b == a:
                continue
            if keys[a] != shard:
                flush()
                shard, members = keys[a], []
            elif b - a == 1 and not members:
                continue
            members.extend(fps[a:b].tolist())
        if out:
            x = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
            out.clear()
    flush()
    if out:
        x = np.array(out, np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])


def links(distinct_fps: DataFrame) -> DataFrame:
    """Links (a, b), b < a unsigned, that connect exactly the fingerprints whose components are one. Input: distinct fp."""
    dealt = distinct_fps.select("fp").mapInArrow(lean(_deal), "shard bigint, fp bigint")
    n = dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return dealt.repartition(int(n), "shard").sortWithinPartitions("shard").mapInArrow(lean(_trees), "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the least node of its component (as a signed long).

    Alternates large-star and small-star; each step sees only a node's own neighbours, as minima and joins.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    while True:
        # large-star: every neighbour above a node is linked to the least of the node and its neighbours
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small-star: a node and its lesser neighbours are linked to the least of these
        large = materialize(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(least.select("a", F.col("m").alias("b"))).distinct()
        new = materialize(small, "small")
        done = _same(now, new)
        discard(now)
        discard(large)
        now = new
        if done:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _same(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables of distinct links are the same, by counts and two sums of hashes."""
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.hash("b", "a").cast("bigint"))]
    return a.agg(*mark).first() == b.agg(*mark).first()


def _grouped(docs: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """key, fp, root (a fingerprint that names the component), component_id and the columns in keep, for each row."""
    prints = materialize(fingerprints(docs, key, text, keep), "fingerprints")
    least = materialize(prints.groupBy("fp").agg(F.min(key).alias("own")), "distinct")
    roots = components(links(least.select("fp")))
    grouped = least.join(roots, least["fp"] == roots["node"], "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    ids = grouped.groupBy("root").agg(F.min("own").alias("component_id"))
    return prints.join(grouped.select("fp", "root").join(ids, "root"), "fp")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (least key reachable, its own included) and the columns in keep, a
    row for each row of docs.

    Null, empty and blank texts have fingerprint 0 and are linked like any other. Repeated rows share their component.
    Null keys stay; a component with no other key has component_id null.
    """
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    # the columns in keep go along as one, so that no name can clash
    kept = [F.struct(*[docs[c].alias(f"x{i}") for i, c in enumerate(keep)]).alias("kept")] if keep else []
    rows = docs.select(docs[key].alias("k"), docs[text].alias("t"), *kept)
    grouped = _grouped(rows, "k", "t", ("kept",) if keep else ())
    return grouped.select(F.col("k").alias(key), hexed.alias("fingerprint"), "component_id", *[F.col(f"kept.x{i}").alias(c) for i, c in enumerate(keep)])


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each group of near-duplicates: that with the least key, and of several texts under it the
    one with the least hash. A null key is kept only where its group has no other. Rows that repeat both key and text are
    one document and stay together. Columns are those of docs.
    """
    marked = docs.select(docs[key].alias("_k"), docs[text].alias("_t"), F.xxhash64(docs[text]).alias("_th"))
    first = _grouped(marked, "_k", "_t", ("_th",)).groupBy("root").agg(F.min(F.struct(F.col("_k").isNull().alias("z"), "_k", "_th")).alias("r"))
    kept = first.select("r._k", "r._th")
    return docs.join(kept, docs[key].eqNullSafe(kept["_k"]) & (F.xxhash64(docs[text]) == kept["_th"]), "left_semi")


def _xxh64(table: str, column: str) -> str:
    """SQL queries x0 to x5 that give (column, h): the XXH64 of each text of the table, by 128-bit arithmetic."""
    # fixed values: the primes of XXH64
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    m = "18446744073709551616::UHUGEINT"

    def turned(x: str, bits: int | str) -> str:
        power = f"{1 << bits}::UHUGEINT" if isinstance(bits, int) else bits
        return f"(({x}) * {power} % {m} + ({x}) * {power} // {m})"

    def lane(first: str, size: int) -> str:
        return "(" + " + ".join(f"b[{first} + {k + 1}] * {256**k}::UHUGEINT" for k in range(size)) + ")"

    def stripe(i: int, start: str) -> str:
        return f"list_reduce(list_transform(generate_series(0, n // 32 - 1), lambda j: {lane(f'j * 32 + {8 * i}', 8)}), lambda a, x: {turned(f'(a + x * {p2}) % {m}', 31)} * {p1} % {m}, {start})"

    step = f"list_reduce(steps, lambda a, x: ({turned('xor(a, x.v)', 'x.t')} * x.p + x.q) % {m}, a0)"
    eights = f"list_transform(generate_series(0, n % 32 // 8 - 1), lambda j: struct_pack(v := {turned(f'{lane("n // 32 * 32 + j * 8", 8)} * {p2} % {m}', 31)} * {p1} % {m}, t := {1 << 27}::UHUGEINT, p := {p1}, q := {p4}))"
    four = f"CASE WHEN n % 8 >= 4 THEN [struct_pack(v := {lane('n // 8 * 8', 4)} * {p1} % {m}, t := {1 << 23}::UHUGEINT, p := {p2}, q := {p3})] ELSE [] END"
    ones = f"list_transform(generate_series(n // 4 * 4, n - 1), lambda j: struct_pack(v := b[j + 1] * {p5} % {m}, t := {1 << 11}::UHUGEINT, p := {p1}, q := 0::UHUGEINT))"
    merged = f"list_reduce([v1, v2, v3, v4], lambda a, v: (xor(a, {turned(f'v * {p2} % {m}', 31)} * {p1} % {m}) * {p1} + {p4}) % {m}, ({turned('v1', 1)} + {turned('v2', 7)} + {turned('v3', 12)} + {turned('v4', 18)}) % {m})"
    digits = "instr('123456789ABCDEF', substring(hx, {}, 1))::UHUGEINT"
    return f"""x0 AS (SELECT {column}, hex(encode({column})) AS hx FROM {table}),
x1 AS (SELECT {column}, length(hx) // 2 AS n, list_transform(generate_series(1, length(hx) // 2), lambda i: {digits.format("2 * i - 1")} * 16::UHUGEINT + {digits.format("2 * i")}) AS b FROM x0),
x2 AS (SELECT *, {stripe(0, f"({SEED} + {p1} + {p2}) % {m}")} AS v1, {stripe(1, f"({SEED} + {p2}) % {m}")} AS v2, {stripe(2, f"{SEED}::UHUGEINT")} AS v3, {stripe(3, f"({SEED} + {m} - {p1}) % {m}")} AS v4 FROM x1),
x3 AS (SELECT {column}, (CASE WHEN n >= 32 THEN {merged} ELSE {SEED} + {p5} END + n::UHUGEINT) % {m} AS a0, list_concat(list_concat({eights}, {four}), {ones}) AS steps FROM x2),
x4 AS (SELECT {column}, CASE WHEN len(steps) > 0 THEN {step} ELSE a0 END AS a FROM x3),
x5 AS (SELECT {column}, xor(c, c // {1 << 32}::UHUGEINT)::UBIGINT AS h FROM (SELECT {column}, xor(b, b // {1 << 29}::UHUGEINT) * {p3} % {m} AS c FROM (SELECT {column}, xor(a, a // {1 << 33}::UHUGEINT) * {p2} % {m} AS b FROM x4)))"""


_BITS = " + ".join(f"(2 * sum((h >> {b}) & 1) > count(*))::UHUGEINT * {1 << b}::UHUGEINT" for b in range(64))
ORACLE = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, unnest(list_transform(generate_series(1, greatest(1, len(w) - {SHINGLE - 1})), lambda i: array_to_string(w[i:i + {SHINGLE - 1}], ' '))) AS s FROM d WHERE len(w) > 0),
u AS (SELECT DISTINCT s FROM s),
{_xxh64("u", "s")},
f AS (SELECT r, ({_BITS})::UBIGINT AS fp FROM s JOIN x5 USING (s) GROUP BY r),
g AS (SELECT doc_id, coalesce(fp, 0)::UBIGINT AS fp FROM d LEFT JOIN f USING (r)),
k AS (SELECT fp, min(doc_id) AS own FROM g GROUP BY fp),
e AS (SELECT a.fp AS a, b.fp AS b FROM k a JOIN k b ON bit_count(xor(a.fp, b.fp)) <= {RADIUS}),
c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
i AS (SELECT a AS fp, min(own) AS component_id FROM c JOIN k ON c.b = k.fp GROUP BY a)
SELECT doc_id, lower(lpad(to_hex(fp), 16, '0')) AS fingerprint, component_id FROM g JOIN i USING (fp)
"""
