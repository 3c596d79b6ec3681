"""Approximate nearest neighbours by learned partitions.

1. A bounded sample of the vectors gets its exact neighbour graph (block matrix
   products).
2. The graph is cut into balanced parts, one per ``PART_ROWS`` rows of the table:
   parts grow from balanced centres, then vertices move to the part that holds most
   of their neighbours while no part exceeds its capacity.
3. A small classifier (softmax regression) learns part from vector, with the
   parts of a vertex and its neighbours as soft target.
4. Every row of the table is assigned to its most probable part; a query is routed
   to its most probable parts until they hold a probability mass, and reranked there
   by the exact inner product in double precision. The first part is searched
   alone: its k-th score bounds what the others need to return.

The mass is measured, not set: on held-out rows of the sample it is the least one
whose parts hold ``TARGET`` of their exact neighbours. So queries that are easy to
place visit few parts and hard ones many, and vectors without structure make all
queries visit more. ``target=1`` visits every part, which is the exact search.

The index covers every row; only the graph and the classifier are fitted on the
sample. Parts grow with the table up to ``SAMPLE`` / ``PART_SAMPLE``. A part is
scanned in blocks of at most ``BLOCK`` rows and its queries in blocks too, so a part
that attracts a third of all rows is many tasks.

Defined results: vectors that are null, zero, or hold null or non-finite
components, or differ in length from the most frequent length of the sample, take
no part; a null id takes no part; rows that share an id are rows of their own
(each query row has its result, and leaves out only itself); ties go to the smaller
id; a table with few vectors is one part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import named, ship, written

ship(__name__)

SAMPLE = 16384              # bound of the sample: expected rows
PART_ROWS = 1024            # rows of the table for each part,
PART_SAMPLE = 32            # as long as a part has so many rows of the sample
HELD_OUT = 8                # one sample row in so many measures the probability mass
TARGET = 0.94               # share of the held-out rows' neighbours that it must reach
NEIGHBOURS = 20
BLOCK = 16384               # rows of a part scanned at once
QUERY_BLOCK = 4096
EPOCHS = 60


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, id, v) of the rows that take part; ``row`` tells them apart."""
    v = named(vector).cast("array<double>")
    # a comparison with null is null and drops the row
    ok = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0)
    return (rows.where(named(key).isNotNull() & named(vector).isNotNull()).where(ok)
            .select(F.monotonically_increasing_id().alias("row"), named(key).cast("long").alias("id"), v.alias("v")))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of the k rows with the largest inner product, block by block."""
    n = len(x)
    k = min(k, n - 1)
    out = np.zeros((n, max(k, 0)), dtype=np.int64)
    if k <= 0:
        return out
    for lo in range(0, n, 1024):
        s = x[lo:lo + 1024] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out[lo:lo + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 5) -> np.ndarray:
    """Part of each vertex; no part holds more than 1.25 times the mean."""
    n = len(x)
    if parts <= 1 or n == 0:
        return np.zeros(n, dtype=np.int64)
    capacity = math.ceil(1.25 * n / parts)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(n, parts, replace=False)].copy()
    part = np.zeros(n, dtype=np.int64)

    def deal(gain: np.ndarray) -> np.ndarray:
        """Every vertex to the open part of its highest gain, strongest preference first."""
        out, room = np.full(n, -1), np.full(parts, capacity)
        wish = np.argsort(-gain, axis=1, kind="stable")
        strength = np.take_along_axis(gain, wish[:, :1], 1)[:, 0]
        waiting = np.argsort(-strength, kind="stable")
        for rank in range(parts):
            if not len(waiting):
                break
            want = wish[waiting, rank]
            order = np.argsort(want, kind="stable")
            place = np.arange(len(want)) - np.searchsorted(want[order], want[order])
            fits = np.zeros(len(want), dtype=bool)
            fits[order] = place < room[want[order]]
            out[waiting[fits]] = want[fits]
            room -= np.bincount(want[fits], minlength=parts)
            waiting = waiting[~fits]
        return out

    for _ in range(12):
        part = deal(x @ centres.T)
        for p in range(parts):
            own = x[part == p]
            if len(own):
                c = own.mean(axis=0)
                centres[p] = c / max(np.linalg.norm(c), 1e-12)
    if graph.shape[1]:
        for _ in range(8):                                  # move to where the neighbours are
            votes = np.zeros((n, parts), dtype=np.float64)
            for j in range(graph.shape[1]):
                votes[np.arange(n), part[graph[:, j]]] += 1.0
            part = deal(votes + 0.5 * (np.arange(parts)[None, :] == part[:, None]) + 0.01 * (x @ centres.T))
    return part


def fit_router(x: np.ndarray, target: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression (Adam) from vectors to part shares: weights, bias."""
    n, parts = target.shape
    w, b = np.zeros((x.shape[1], parts)), np.zeros(parts)
    m = [np.zeros_like(w), np.zeros_like(b)]
    s = [np.zeros_like(w), np.zeros_like(b)]
    rng, step = np.random.default_rng(seed), 0
    for _ in range(EPOCHS if n else 0):
        order = rng.permutation(n)
        for lo in range(0, n, 1024):
            at = order[lo:lo + 1024]
            z = x[at] @ w + b
            z -= z.max(axis=1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(axis=1, keepdims=True)
            g = (p - target[at]) / len(at)
            step += 1
            for k, (param, grad) in enumerate(((w, x[at].T @ g), (b, g.sum(axis=0)))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                s[k] = 0.999 * s[k] + 0.001 * grad * grad
                param -= 0.05 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
    return w, b


class Router:
    """Classifier from vectors to parts, fitted on a sample."""

    def __init__(self, vectors: np.ndarray, parts: int = 1, target: float = TARGET):
        x = np.asarray(vectors, dtype=np.float64)
        self.scale = float(np.sqrt((x * x).sum(axis=1).mean())) if len(x) else 1.0
        x = x / (self.scale or 1.0)
        held_out = np.arange(len(x)) % HELD_OUT == 0 if parts > 1 else np.zeros(len(x), dtype=bool)
        x, asked = x[~held_out], x[held_out]
        self.parts = max(1, min(parts, len(x)))
        graph = neighbour_graph(x, NEIGHBOURS)
        part = balanced_parts(x, graph, self.parts)
        goal = np.zeros((len(x), self.parts))
        goal[np.arange(len(x)), part] += 2.0
        for j in range(graph.shape[1]):
            goal[np.arange(len(x)), part[graph[:, j]]] += 1.0
        goal /= np.maximum(goal.sum(axis=1, keepdims=True), 1e-12)
        self.w, self.b = fit_router(x, goal)
        self.mass = self._mass(x, asked, target)

    def _mass(self, x: np.ndarray, asked: np.ndarray, target: float) -> float:
        """The least probability mass whose parts hold ``target`` of the neighbours
        of the held-out rows (1: all parts)."""
        if self.parts == 1 or target >= 1 or not len(asked):
            return 1.0
        home, need = self._probability(x).argmax(axis=1), []
        for lo in range(0, len(asked), 512):
            y = asked[lo:lo + 512]
            k = min(NEIGHBOURS, len(x))
            near = np.argpartition(-(y @ x.T), k - 1, axis=1)[:, :k]
            order, before = self._visits(self._probability(y))
            spent = np.empty_like(before)
            np.put_along_axis(spent, order, before, axis=1)  # mass visited before each part
            need.append(np.take_along_axis(spent, home[near], axis=1).ravel())
        need = np.sort(np.concatenate(need))
        return float(need[min(len(need) - 1, math.ceil(target * len(need)))]) + 1e-12

    def _probability(self, x: np.ndarray) -> np.ndarray:
        z = x @ self.w + self.b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    @staticmethod
    def _visits(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parts in the order of their probability, and the mass before each."""
        order = np.argsort(-p, axis=1, kind="stable")
        ranked = np.take_along_axis(p, order, axis=1)
        return order, np.cumsum(ranked, axis=1) - ranked

    def home(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the most probable part of each vector."""
        return np.arange(len(vectors)), self._probability(vectors / (self.scale or 1.0)).argmax(axis=1)

    def visited(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the parts that each vector visits."""
        order, before = self._visits(self._probability(vectors / (self.scale or 1.0)))
        row, at = np.nonzero((before < self.mass) | (self.mass >= 1.0))
        return row, order[row, at]


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def build(vectors: DataFrame, sample: int = SAMPLE, part_rows: int = PART_ROWS, target: float = TARGET) -> tuple[Router, int]:
    """Fit the router on about ``sample`` rows, drawn by the hash of their row
    number. Returns it with the common vector length."""
    n = vectors.count()
    share = F.lit(min(1.0, sample / max(n, 1)))
    rows = vectors.where(F.xxhash64("row", F.lit("sample")) / F.lit(2.0 ** 64) + 0.5 <= share).orderBy("id", "row").collect()
    sizes = [len(r["v"]) for r in rows]
    dim = max(sorted(set(sizes)), key=sizes.count) if sizes else 0
    same = [r["v"] for r in rows if len(r["v"]) == dim]
    parts = max(1, min(math.ceil(n / part_rows), len(same) // PART_SAMPLE))
    return Router(np.array(same, dtype=np.float64).reshape(len(same), dim), parts, target), dim


def search(rows: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding",
           target: float = TARGET, sample: int = SAMPLE, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where ``is_query`` (a
    condition on ``id``) holds, the ``k`` nearest other rows that its parts hold."""
    vectors = written(usable(rows, key, vector), "vectors")
    router, dim = build(vectors, sample, part_rows, target)
    vectors = vectors.where(F.size("v") == dim)

    def route(choose):
        def run(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 4096):
                    some = batch.slice(lo, 4096)
                    row, part = getattr(router, choose)(_matrix(some.column("v")))
                    at, first = pa.array(row), np.append(True, row[1:] != row[:-1])[:len(row)]
                    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(first), *[some.column(c).take(at) for c in ("row", "id", "v")]],
                                                     names=["part", "first", "row", "id", "v"])
        return run

    schema = "part int, first boolean, row long, id long, v array<double>"
    placed = written(vectors.mapInArrow(route("home"), schema), "index")
    asked = written(vectors.where(is_query).mapInArrow(route("visited"), schema), "asked")
    near = written(_meet(placed, asked.where("first").withColumn("least", F.lit(float("-inf"))), k), "first-parts")
    # fewer than k found bound nothing
    bound = near.groupBy("query").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
    further = (asked.where("NOT first").join(bound.withColumnRenamed("query", "row"), "row", "left")
               .withColumn("least", F.coalesce("least", F.lit(float("-inf")))))
    near = near.unionByName(_meet(placed, further, k))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _meet(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, query_id, vec_id, score): for every query, in every part it is routed
    to, the ``k`` nearest rows of each block that reach the query's ``least`` score."""
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))                 # one row per part
    asked_sizes = asked.groupBy("part").agg(F.count("*").alias("n"))
    blocks = {r["part"]: math.ceil(r["n"] / BLOCK) for r in sizes.collect()}
    query_blocks = {r["part"]: math.ceil(r["n"] / QUERY_BLOCK) for r in asked_sizes.collect()}
    if not blocks or not query_blocks:
        return placed.sparkSession.createDataFrame([], "query long, query_id long, vec_id long, score double")

    def of(table):
        return F.create_map(*[x for p, n in table.items() for x in (F.lit(p), F.lit(n))])

    def block(n, salt):
        return F.pmod(F.xxhash64("row", F.lit(salt)), n.cast("long")).cast("int")

    # a task holds one block of a part and one block of the queries routed to it
    held = (placed.where(F.col("part").isin(list(query_blocks))).withColumn("c", block(of(blocks)[F.col("part")], "c"))
            .withColumn("q", F.explode(F.sequence(F.lit(0), of(query_blocks)[F.col("part")] - 1))))
    sent = (asked.where(F.col("part").isin(list(blocks))).withColumn("q", block(of(query_blocks)[F.col("part")], "q"))
            .withColumn("c", F.explode(F.sequence(F.lit(0), of(blocks)[F.col("part")] - 1))))

    def rerank(left, right):
        out_r, out_q, out_i, out_s = [], [], [], []
        if left.num_rows and right.num_rows:
            ids = np.asarray(left.column("id").combine_chunks())
            order = np.argsort(ids, kind="stable")
            ids, x, own = ids[order], _matrix(left.column("v").combine_chunks())[order], np.asarray(left.column("row").combine_chunks())[order]
            asks, y = np.asarray(right.column("id").combine_chunks()), _matrix(right.column("v").combine_chunks())
            askers, least = (np.asarray(right.column(c).combine_chunks()) for c in ("row", "least"))
            for lo in range(0, len(asks), 256):
                s = y[lo:lo + 256] @ x.T
                s[own[None, :] == askers[lo:lo + 256, None]] = -np.inf
                top = min(k, s.shape[1])
                edge = np.maximum(-np.partition(-s, top - 1, axis=1)[:, top - 1], least[lo:lo + 256])
                for r in range(len(s)):
                    # a little slack for the rounding of the block product; then exact scores and ties by id
                    at = np.flatnonzero((s[r] >= edge[r] - 1e-9 * max(1.0, abs(edge[r]))) & (s[r] > -np.inf))
                    score = (x[at] * y[lo + r]).sum(axis=1)
                    best = np.lexsort((ids[at], -score))[:k]
                    best = best[score[best] >= least[lo + r]]
                    out_r.append(np.full(len(best), askers[lo + r]))
                    out_q.append(np.full(len(best), asks[lo + r]))
                    out_i.append(ids[at][best])
                    out_s.append(score[best])
        empty = [np.zeros(0, np.int64)]
        return pa.table({"query": np.concatenate(out_r or empty), "query_id": np.concatenate(out_q or empty),
                         "vec_id": np.concatenate(out_i or empty), "score": np.concatenate(out_s or [np.zeros(0)])})

    return (held.groupBy("part", "c", "q").cogroup(sent.groupBy("part", "c", "q"))
            .applyInArrow(rerank, "query long, query_id long, vec_id long, score double"))
