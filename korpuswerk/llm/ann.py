"""Approximate nearest neighbours by balanced posting lists.

Centroids are fitted on a bounded sample, with lists kept even by a charge on full ones. Every distinct vector goes to its
nearest list and, if it lies near a boundary, to the others within REPLICA times that distance. A query reads all lists
within a ratio of its least distance to a centroid, however many they are; centroids are ordered exactly. The ratio is
measured on the table itself: ASKED queries are answered by brute force over all vectors, and it is the least at which
RECALL of what they find lies in lists that are read. Lists are read in chunks of bounded size, so that a large one is no
single task, and scores are exact. The FIRST nearest lists are read before the others: what they give is a floor, and the
others then send on only what reaches it.

Inner products become distances by one more component that gives all vectors the greatest norm.

Equal vectors are indexed once, with the least TOP + 1 of their ids: of rows with equal scores the least ids win, so no
further one can be in a result. Queries with equal vectors are searched once, too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import lean, materialize

TOP = 20
#: Vectors of a list, at first; most lists; bytes that all centroids may take.
LIST, MOST_LISTS, CENTROID_BYTES = 512, 16384, 64 << 20
#: Vectors for fitting: so many for each list, at least and at most.
PER_LIST, SAMPLE_LEAST, SAMPLE_MOST = 16, 8192, 131_072
REPLICA, MOST_REPLICAS = 1.02, 3
#: Queries answered by brute force, and the share of their neighbours that the lists read must hold.
ASKED, RECALL, LEAST_LISTS = 256, 0.96, 8
#: Pairs of query and list that are worked out at once.
PAIRS = 65_536
CHUNK = 4096
FIRST = 3


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0)


def _split(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """k centroids of x and each row's, by rounds of means in which fuller lists are charged."""
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    charge, near = np.zeros(k), np.zeros(len(x), np.int64)
    for r in range(rounds):
        d = _distances(x, c) + charge
        near = d.argmin(1)
        size = np.bincount(near, minlength=k)
        scale = np.median(d.min(1))
        charge = charge + 0.03 * scale * np.clip(size / (len(x) / k) - 1, -0.5, 1) if r < rounds - 3 else 0 * charge
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        some = size > 0
        c[some] = sums[some] / size[some, None]
        if not some.all():  # an empty list takes a far vector
            c[~some] = x[np.argsort(-d.min(1))[: int((~some).sum())]]
    return c, near


def fit(x: np.ndarray, k: int, seed: int = 11) -> np.ndarray:
    """k centroids, in two levels where there are many."""
    rng = np.random.default_rng(seed)
    if k <= 512:
        return _split(x, k, rng)[0]
    _, near = _split(x, int(k**0.5), rng)
    parts = [x[near == i] for i in np.unique(near)]
    return np.concatenate([_split(p, max(1, round(k * len(p) / len(x))), rng)[0] for p in parts])


class Graph:
    """Centroids linked to their nearest ones and a few others; searched for whole batches, best first."""

    def __init__(self, centroids: np.ndarray, degree: int = 16, far: int = 4, seed: int = 13):
        self.c = centroids.astype(np.float32)
        n = len(centroids)
        rng = np.random.default_rng(seed)
        near = np.empty((n, min(degree, n)), np.int32)
        for i in range(0, n, 1024):
            near[i : i + 1024] = np.argsort(_distances(self.c[i : i + 1024], self.c), 1)[:, : near.shape[1]]
        self.links = np.concatenate([near, rng.integers(0, n, (n, far), dtype=np.int32)], 1)
        self.entries = rng.choice(n, min(n, 16), replace=False).astype(np.int32)

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, `width` near centroids and their distances, nearest first; -1 and infinity beyond the last."""
        out = [self._search(x[i : i + 512].astype(np.float32), width) for i in range(0, len(x), 512)]
        return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])

    def _search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(x), min(width, len(self.c))
        beam = max(width, min(len(self.c), 32))
        norms, own = (self.c * self.c).sum(1), (x * x).sum(1)
        ids = np.full((n, beam), -1, np.int32)
        dist = np.full((n, beam), np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        seen = np.zeros((n, len(self.c)), bool)
        todo, found = np.arange(n), np.broadcast_to(self.entries, (n, len(self.entries)))
        while len(todo):
            order = np.sort(found, 1)
            fresh = ~seen[todo[:, None], order]
            fresh[:, 1:] &= order[:, 1:] != order[:, :-1]
            seen[todo[:, None], order] = True
            d = own[todo, None] + norms[order] - 2 * np.einsum("nd,nkd->nk", x[todo], self.c[order])
            d = np.where(fresh, np.maximum(d, 0), np.inf)
            all_d = np.concatenate([dist[todo], d], 1)
            all_i = np.concatenate([ids[todo], np.where(fresh, order, -1)], 1)
            all_o = np.concatenate([open_[todo], fresh], 1)
            best = np.argsort(all_d, 1, kind="stable")[:, :beam]
            take = lambda a: np.take_along_axis(a, best, 1)  # noqa: E731, B023
            dist[todo], ids[todo], open_[todo] = take(all_d), take(all_i), take(all_o)
            left = open_[todo].any(1)
            todo = todo[left]
            at = open_[todo].argmax(1)
            open_[todo, at] = False
            found = self.links[ids[todo, at]]
        return ids[:, :width], np.sqrt(dist[:, :width])


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def valid(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part: ids that aren't null, vectors that are neither empty nor zero nor hold null or
    non-finite components."""
    v = table.select(table[key].cast("bigint").alias("id"), table[vector].cast("array<double>").alias("v"))
    return v.where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x != 0)")


def search(table: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = 20, top: int = TOP, ratio: float | None = None, least_lists: int = LEAST_LISTS, list_size: int = LIST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each row whose id is divisible by `every`, the `top` rows found with the
    largest inner products, itself left out; of equal scores the smaller id first. ratio is measured if none is given. Rows
    that repeat an id and vector count once. See valid() for rows that take no part; without any the result is empty. Vectors
    of different lengths have no inner product: each length, of which a table has one or a few, has an index of its own."""
    rows = valid(table, key, vector).distinct()
    lengths = sorted(r.n for r in rows.select(F.size("v").alias("n")).distinct().collect())
    found = [_search(rows.where(F.size("v") == n), n, every, top, ratio, least_lists, list_size) for n in lengths or [1]]
    return reduce(DataFrame.union, found)


def _search(rows: DataFrame, dim: int, every: int, top: int, ratio: float | None, least_lists: int, list_size: int) -> DataFrame:
    """The same for rows (id, v) of one length."""
    spark = rows.sparkSession
    ranked = rows.withColumn("_r", F.expr("row_number() OVER (PARTITION BY v ORDER BY id)")).where(F.col("_r") <= top + 1)
    kinds = ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    kinds = materialize(kinds.select(F.col("ids")[0].alias("did"), "ids", "v"), "vectors")
    size = kinds.agg(F.count("*").alias("n"), F.max(F.expr("aggregate(v, 0D, (a, x) -> a + x * x)")).alias("m")).first()
    norm2, n_lists = size.m or 1.0, max(1, min(-(-size.n // list_size), MOST_LISTS, CENTROID_BYTES // (4 * dim)))
    sample = kinds.orderBy(F.xxhash64("did")).limit(min(SAMPLE_MOST, max(SAMPLE_LEAST, PER_LIST * n_lists))).select("v").toArrow()
    flat = _matrix(sample.column("v").combine_chunks(), dim) if sample.num_rows else np.ones((1, dim))
    graph = Graph(fit(_lifted(flat, norm2), n_lists))
    sent = spark.sparkContext.broadcast(graph)  # at most CENTROID_BYTES and the links

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, dist = sent.value.search(_lifted(_matrix(batch.column(1), dim), norm2), MOST_REPLICAS)
            row, col = np.nonzero((ids >= 0) & (dist <= dist[:, :1] * REPLICA + 1e-9))
            yield pa.RecordBatch.from_arrays([pa.array(ids[row, col]), batch.column(0).take(row), batch.column(1).take(row)], ["list", "did", "v"])

    postings = materialize(kinds.select("did", "v").mapInArrow(lean(assign), "list int, did bigint, v array<double>"), "postings")
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # a row a list
    full = np.zeros(len(graph.c), np.int64)
    full[list(sizes)] = list(sizes.values())
    chunks = np.maximum(1, -(-full // CHUNK)).astype(np.int32)

    queries = rows.where(F.col("id") % every == 0)
    asked = materialize(queries.groupBy("v").agg(F.min("id").alias("qid")), "queries")
    if ratio is None:
        ratio = _measured(asked, kinds, postings, graph.c, full, norm2, top, least_lists)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, step = np.flatnonzero(full > 0).astype(np.int32), max(1, PAIRS // len(full))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                ids, dist = _ordered(_raised(_matrix(batch.column(1), dim), norm2), sent.value.c)
                there = full[ids] > 0
                near = there & (dist <= dist[:, :1] * ratio) | there & (np.cumsum(there, 1) <= least_lists)
                short = ~(near & (full[ids] > top)).any(1)  # no list alone has enough: all lists
                row, col = np.nonzero(near & ~short[:, None])
                at, place = ids[row, col], np.cumsum(near, 1)[row, col] - 1
                row = np.concatenate([row, np.repeat(np.flatnonzero(short), len(some))])
                at, place = np.concatenate([at, np.tile(some, int(short.sum()))]), np.concatenate([place, np.zeros(len(some) * int(short.sum()), np.int64)])
                rep = chunks[at]
                part = np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
                row, at, place = np.repeat(row, rep), np.repeat(at, rep), np.repeat(place, rep)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(part.astype(np.int32)), pa.array(place.astype(np.int32)), batch.column(0).take(row), batch.column(1).take(row)], ["list", "part", "place", "qid", "q"])

    def scan(posting: pa.Table, queries: pa.Table) -> pa.Table:
        kept: list[tuple] = []
        if posting.num_rows and queries.num_rows:
            v, q = _matrix(posting.column("v").combine_chunks(), dim), _matrix(queries.column("q").combine_chunks(), dim)
            did, qid, floor = posting.column("did").to_numpy(), queries.column("qid").to_numpy(), queries.column("floor").to_numpy()
            for i in range(0, len(q), 512):
                s = q[i : i + 512] @ v.T
                k = min(len(v), top + 1)
                cut = np.maximum(np.partition(s, len(v) - k, 1)[:, len(v) - k], floor[i : i + 512])
                r, c = np.nonzero(s >= cut[:, None] - 1e-9 * np.abs(cut[:, None]) - 1e-300)
                exact = np.cumsum(q[i + r] * v[c], 1)[:, -1]  # one product after the other, so that anyone gets the same sum
                high = exact >= floor[i + r]
                r, c, exact = r[high], c[high], exact[high]
                order = np.lexsort((did[c], -exact, r))
                r, c, exact = r[order], c[order], exact[order]
                place = np.arange(len(r)) - np.searchsorted(r, r)
                r, c, exact = r[place < k], c[place < k], exact[place < k]
                kept.append((qid[i + r], did[c], exact))
        cols = [np.concatenate(x) for x in zip(*kept, strict=True)] if kept else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(("qid", "did", "score"), cols, strict=True)))

    probes = asked.select("qid", "v").mapInArrow(lean(probe), "list int, part int, place int, qid bigint, q array<double>")
    split = spark.createDataFrame([(i, int(n)) for i, n in enumerate(chunks)], "list int, n int")  # a row a list
    dealt = postings.join(F.broadcast(split), "list").withColumn("part", F.pmod(F.xxhash64("did"), F.col("n")).cast("int"))

    def read(asking: DataFrame) -> DataFrame:
        return dealt.groupBy("list", "part").cogroup(asking.groupBy("list", "part")).applyInArrow(scan, "qid bigint, did bigint, score double")

    def leading(scored: DataFrame) -> DataFrame:
        return scored.distinct().withColumn("_r", F.expr("row_number() OVER (PARTITION BY qid ORDER BY score DESC, did)")).where(F.col("_r") <= top + 1).drop("_r")

    first = materialize(leading(read(probes.where(F.col("place") < FIRST).drop("place").withColumn("floor", F.lit(float("-inf"))))), "first")
    floors = first.groupBy("qid").agg(F.when(F.count("*") > top, F.min("score")).alias("floor"))
    others = probes.where(F.col("place") >= FIRST).drop("place").join(floors, "qid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    best = leading(first.union(read(others)))
    listed = best.join(kinds.select("did", "ids"), "did").select("qid", F.explode("ids").alias("id"), "score")
    ahead = listed.groupBy("qid").agg(F.slice(F.expr("array_sort(collect_list(struct(-score AS s, id)))"), 1, top + 1).alias("found"))
    answers = asked.join(ahead, "qid").select("v", "found")
    out = queries.join(answers, "v").select(F.col("id").alias("query_id"), F.posexplode(F.expr(f"slice(filter(found, x -> x.id != id), 1, {top})")).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def _lifted(x: np.ndarray, norm2: float) -> np.ndarray:
    """x with the component that brings all rows to the greatest norm."""
    return np.append(x, np.sqrt(np.maximum(norm2 - (x * x).sum(1, keepdims=True), 0)), 1)


def _raised(q: np.ndarray, norm2: float) -> np.ndarray:
    """Queries at the greatest norm, without a part in the further component."""
    return np.append(q * (norm2 / (q * q).sum(1, keepdims=True)) ** 0.5, np.zeros((len(q), 1)), 1)


def _ordered(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row, all centroids and their distances, nearest first."""
    d = np.sqrt(_distances(x, c))
    ids = np.argsort(d, 1, kind="stable")
    return ids.astype(np.int32), np.take_along_axis(d, ids, 1)


def _true(asked: DataFrame, kinds: DataFrame, top: int) -> tuple[list[int], np.ndarray, DataFrame]:
    """The ids and vectors of at most ASKED queries, and a table (qid, did) of each one's `top` best other vectors, of all."""
    some = asked.orderBy(F.xxhash64(F.lit(1), "qid")).limit(ASKED).collect()  # others than those that centroids are fitted on
    qid, q = np.array([r.qid for r in some], np.int64), np.array([r.v for r in some], np.float64)
    sent = kinds.sparkSession.sparkContext.broadcast((qid, q))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q = sent.value
        score, did = np.zeros((len(q), 0)), np.zeros((len(q), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), q.shape[1])
            s = q @ v.T
            near = np.argpartition(-s, min(top, len(v) - 1), 1)[:, : top + 1]
            own = np.stack([(v[at] == x).all(1) for at, x in zip(near, q, strict=True)])
            score = np.append(score, np.where(own, -np.inf, np.take_along_axis(s, near, 1)), 1)
            did = np.append(did, batch.column(0).to_numpy()[near], 1)
            keep = np.argsort(-score, 1, kind="stable")[:, :top]
            score, did = np.take_along_axis(score, keep, 1), np.take_along_axis(did, keep, 1)
        row, col = np.nonzero(score > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(qid[row]), pa.array(did[row, col]), pa.array(score[row, col])], ["qid", "did", "score"])

    found = kinds.select("did", "v").mapInArrow(lean(best), "qid bigint, did bigint, score double")
    ranked = found.withColumn("_r", F.expr("row_number() OVER (PARTITION BY qid ORDER BY score DESC, did)"))
    return qid.tolist(), q, ranked.where(F.col("_r") <= top).select("qid", "did")


def _measured(asked: DataFrame, kinds: DataFrame, postings: DataFrame, c: np.ndarray, full: np.ndarray, norm2: float, top: int, least_lists: int) -> float:
    """The least ratio at which a sample of queries finds RECALL of its true neighbours."""
    qid, q, true = _true(asked, kinds, top) if not asked.isEmpty() else ([], None, None)
    found = postings.select("did", "list").join(F.broadcast(true), "did").select("qid", "did", "list").collect() if qid else []  # MOST_REPLICAS rows a neighbour
    if not found:
        return 1.0
    ids, dist = _ordered(_raised(q, norm2), c)
    place = np.cumsum(full[ids] > 0, 1)
    need = np.where(place <= least_lists, 1.0, dist / np.maximum(dist[:, :1], 1e-150))
    by_list = np.empty_like(need)
    np.put_along_axis(by_list, ids, need, 1)
    at, least = {k: i for i, k in enumerate(qid)}, {}
    for r in found:
        least[r.qid, r.did] = min(by_list[at[r.qid], r.list], least.get((r.qid, r.did), np.inf))
    return float(np.quantile(list(least.values()), RECALL, method="higher")) * (1 + 1e-9)


#: The exact result, for tables that fit one list: there every vector is read.
ORACLE = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_reduce(list_transform(list_zip(q.v, e.v), lambda z: z[1] * z[2]), lambda a, x: a + x) AS score
  FROM e q JOIN e ON q.vec_id <> e.vec_id AND len(q.v) = len(e.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
