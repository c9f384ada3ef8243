"""Alignments of two token lists: computing them, and reading groups and n-grams from them."""

from __future__ import annotations

from functools import lru_cache
from heapq import heappop, heappush
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most tokens of a side in a group.
GROUP = 4
#: What each further token of a group costs.
FURTHER = 1.5
#: Tokens that must agree for two lists to run alike again.
SAME = 3
#: How many tokens further another such place is looked for.
WAIT = 3
_MOVES = [(1, 1), *[(k, 1) for k in range(2, GROUP + 1)], *[(1, k) for k in range(2, GROUP + 1)], (1, 0), (0, 1)]


@lru_cache(1 << 16)
def edits(a: str, b: str) -> int:
    """Levenshtein distance in code points, a column of the table as the bits of a number."""
    if a == b:
        return 0
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, out = full, 0, len(a)
    for x in b:
        eq = at.get(x, 0)
        v = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(h | up))
        minus = up & h
        out += bool(plus & last) - bool(minus & last)
        plus = (plus << 1 | 1) & full
        minus = minus << 1 & full
        up = minus | (full & ~(v | plus))
        down = plus & v
    return out


def align_tokens(src: list[str], trg: list[str]) -> list[list[int | None]]:
    """Monotone alignment of least cost. A group of k tokens on one side and one on the other costs the edit distance of
    their texts and FURTHER for each token beyond the first; a token left alone costs its length.

    Where the lists run alike they are paired without a search. From where they part (and the token before) up to where SAME
    tokens agree again (and the first of these) the least cost is searched for.
    """
    out: list[list[int | None]] = []
    i = j = 0
    n, m = len(src), len(trg)
    left = _left(src), _left(trg)
    while i < n or j < m:
        while i < n and j < m and src[i] == trg[j]:
            out.append([i, j])
            i, j = i + 1, j + 1
        if i == n and j == m:
            break
        a, b = _meet(src, trg, i, j, left)
        if out and i and j and out[-1] == [i - 1, j - 1]:
            out.pop()
            i, j = i - 1, j - 1
        if a < n and b < m:
            a, b = a + 1, b + 1
        out += [[x if x is None else x + i, y if y is None else y + j] for x, y in _search(src[i:a], trg[j:b])[1]]
        i, j = a, b
    return out


def _left(tokens: list[str]) -> list[int]:
    """The length of what is left from each place on."""
    return list(accumulate(map(len, reversed(tokens)), initial=0))[::-1]


def _meet(src: list[str], trg: list[str], i: int, j: int, left: tuple[list[int], list[int]]) -> tuple[int, int]:
    """A near place from i and j on where the next SAME tokens (or all that are left) agree; the ends if there is none. Of
    the nearest one and those up to WAIT tokens further the one is taken from which the whole costs least: the part before
    it, and behind it by how much the lengths of what is left differ. In texts that repeat themselves others agree, too."""
    n, m, far = len(src), len(trg), 8
    while True:
        found, last = [], 2 * far
        for d in range(1, 2 * far + 1):
            if d > last:
                break
            for x in range(max(0, d - far), min(d, far) + 1):
                a, b = i + x, j + d - x
                if a <= n and b <= m and src[a : a + SAME] == trg[b : b + SAME] and (a < n or b == m):
                    found.append((a, b))
                    last = min(last, d + WAIT)
        if len(found) == 1:
            return found[0]
        if found:
            return min(found, key=lambda p: _search(src[i : p[0]], trg[j : p[1]])[0] + abs(left[0][p[0]] - left[1][p[1]]))
        if far >= max(n - i, m - j):
            return n, m
        far *= 2


def _search(src: list[str], trg: list[str]) -> tuple[float, list[list[int | None]]]:
    """The least cost, and the alignment. Best-first search over places in both lists. What is left of a path costs at least by how much the lengths of both
    remainders differ, and a group at least by how much its texts do; so few groups' edit distances are worked out. Of
    paths of equal cost that of the first move in _MOVES is taken, from the end on."""
    n, m = len(src), len(trg)
    at_src, at_trg = _left(src), _left(trg)
    best: dict[tuple[int, int], float] = {}
    # (bound, place, cost up to the place before or, if known, up to this one, the move or none)
    heap: list[tuple] = [(abs(at_src[0] - at_trg[0]), 0, 0, 0.0, 0, 0)]
    end = float("inf")
    while heap and heap[0][0] <= end:
        bound, i, j, cost, a, b = heappop(heap)
        if (i, j) in best:
            continue
        if a and b:
            cost += FURTHER * (a + b - 2) + edits("".join(src[i - a : i]), "".join(trg[j - b : j]))
            if (f := cost + abs(at_src[i] - at_trg[j])) > bound:
                heappush(heap, (f, i, j, cost, 0, 0))
                continue
        best[i, j] = cost
        if i == n and j == m:
            end = cost
            continue
        for a, b in _MOVES:
            k, o = i + a, j + b
            if k > n or o > m or (k, o) in best:
                continue
            x, y = at_src[i] - at_src[k], at_trg[j] - at_trg[o]
            rest = abs(at_src[k] - at_trg[o])
            if a and b:
                heappush(heap, (cost + FURTHER * (a + b - 2) + abs(x - y) + rest, k, o, cost, a, b))
            else:
                heappush(heap, (cost + x + y + rest, k, o, cost + x + y, 0, 0))
    out: list[list[int | None]] = []
    i, j = n, m
    while i or j:
        a, b = next((a, b) for a, b in _MOVES if (was := best.get((i - a, j - b))) is not None and was + _cost(src[i - a : i], trg[j - b : j]) == best[i, j])
        pairs = [[x, y] for x in range(i - a, i) for y in range(j - b, j)] if a and b else [[i - 1, None]] if a else [[None, j - 1]]
        out += pairs[::-1]
        i, j = i - a, j - b
    return best[n, m], out[::-1]


def _cost(src: list[str], trg: list[str]) -> float:
    """What a group costs."""
    x, y = "".join(src), "".join(trg)
    return FURTHER * (len(src) + len(trg) - 2) + edits(x, y) if src and trg else len(x) + len(y)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def align(src: pa.Array, trg: pa.Array) -> pa.Array:
    """[src, trg] index pairs of two token columns, null for a token left alone; null if either list is."""
    made = [None if a is None or b is None else align_tokens(a, b) for a, b in zip(src.to_pylist(), trg.to_pylist(), strict=True)]
    return pa.array(made, pa.list_(pa.list_(pa.int32())))


align = align.asNondeterministic()  # see the note on modifiers


def swapped(alignment: Column) -> Column:
    """The pairs from the other side."""
    return F.transform(alignment, lambda p: F.array(p[1], p[0]))


def targets(alignment: Column, source: Column) -> Column:
    """All targets of a source index, in order; null stands for itself."""
    return F.transform(F.filter(alignment, lambda p: p[0].eqNullSafe(source)), lambda p: p[1])


def group_pairs(pairs: list[list[int | None]]) -> list[tuple[tuple, tuple]]:
    """Distinct (sources, targets) groups of one alignment, in time linear in its pairs but for sorting."""
    by: tuple[dict, dict] = ({}, {})
    for s, t in pairs:
        by[0].setdefault(s, set()).add(t)
        by[1].setdefault(t, set()).add(s)
    order = lambda x: sorted(x, key=lambda i: (i is None, i or 0))
    out = {}
    for t in order(by[1]):
        sources = order(by[1][t])
        out[tuple(sources), tuple(order(by[0][sources[0]]))] = None
    return list(out)


_INTS = T.ArrayType(T.IntegerType())


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("src", _INTS), T.StructField("trg", _INTS)])))
def _groups(alignments: pa.Array) -> pa.Array:
    made = [None if x is None else group_pairs(x) for x in alignments.to_pylist()]
    flat = [g for x in made if x for g in x]
    sides = [pa.array([list(g[i]) for g in flat], pa.list_(pa.int32())) for i in (0, 1)]
    ends = list(accumulate((len(x or ()) for x in made), initial=0))
    offsets = pa.array([None if x is None else o for x, o in zip(made, ends, strict=False)] + [ends[-1]], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(sides, ["src", "trg"]))


def groups(alignment: Column) -> Column:
    """Distinct (sources, targets) index groups. For each target its sources, sorted; then the targets of the first of these.
    Indices are sorted with null last. Groups that cross are given as this rule has them.

    Where every index is in one pair the pairs are the groups; only other rows are worked out in Python.
    """
    side = lambda i: F.transform(alignment, lambda p: p[i])
    single = F.coalesce(~F.exists(alignment, lambda p: p[0].isNull() | p[1].isNull()) & (F.size(F.array_distinct(side(0))) == F.size(alignment)) & (F.size(F.array_distinct(side(1))) == F.size(alignment)), F.lit(False))
    plain = F.transform(F.array_sort(F.transform(alignment, lambda p: F.array(p[1], p[0]))), lambda p: F.struct(F.array(p[1]).alias("src"), F.array(p[0]).alias("trg")))
    return F.when(single, plain).otherwise(_groups(F.when(~single, alignment)))


def ngrams(groups_: Column, src_tok: Column, trg_tok: Column, keep_none: bool, sep: str) -> Column:
    """(orig, norm) texts of groups: their tokens joined, unaligned sides empty; those only if keep_none."""
    text = lambda ids, tok: F.array_join(F.transform(F.filter(ids, lambda i: i.isNotNull()), lambda i: F.get(tok, i)), sep)
    made = F.transform(groups_, lambda g: F.struct(text(g["src"], src_tok).alias("orig"), text(g["trg"], trg_tok).alias("norm")))
    return made if keep_none else F.filter(made, lambda x: (x["orig"] != "") & (x["norm"] != ""))
