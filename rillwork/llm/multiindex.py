"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised separately; a cell is a pair of centroids. A query walks the cells
in order of summed centroid distance, taken from a heap, until it has met a given share of all entries, and the
entries of these cells are ranked by exact distance. The share is measured: it is what lets
``RECALL`` of the true neighbours of some sample queries, found by brute force, be met.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, FloatType

from rillwork.llm.common import least_by_hash, quoted, written

#: Most vectors that centroids are fitted on; a half has as many centroids as the square root of their
#: number. Sample queries that measure recall, and the recall aimed at.
SAMPLE, PROBES, RECALL = 20_000, 100, 0.97
ROUNDS = 12
#: Entries and queries of a block in the exact ranking.
ENTRIES, QUERIES = 8192, 4096
#: Sums of squares within these bounds are exact enough as they are.
SQUARES = (1e-280, 1e300)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec): finite, non-zero vectors of the most common length (of equally common ones the
    shortest). One row per id: of different vectors under one id the smallest counts. Floats stay floats; components
    of any other type are doubles."""
    kind = df.select(quoted(vec_col)).schema[0].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    rows = df.select(quoted(id_col).cast("bigint").alias("vec_id"),
                     quoted(vec_col).cast(f"array<{'float' if single else 'double'}>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite
                      & F.exists("vec", lambda x: x != 0))
    one = written(good.groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    common = one.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return one.where(F.size("vec") == (common["n"] if common else 0))


def matrix(column) -> np.ndarray:
    """The rows of a list column, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def to_centroids(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, as the expanded square gives them; infinite where that overflows."""
    with np.errstate(over="ignore", invalid="ignore"):
        d = (points ** 2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids ** 2).sum(1)
    return np.where(np.isnan(d), np.inf, np.maximum(d, 0))


def centroids_of(points: np.ndarray, k: int) -> np.ndarray:
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    chosen = points[np.random.default_rng(0).permutation(len(points))[:k]]
    for _ in range(ROUNDS):
        near = to_centroids(points, chosen).argmin(1)
        size = np.bincount(near, minlength=k)
        total = np.zeros_like(chosen)
        np.add.at(total, near, points / np.maximum(size, 1)[near][:, None])
        chosen = np.where(size[:, None] > 0, total, chosen)
    return chosen


@dataclass
class Halves:
    first: np.ndarray
    second: np.ndarray

    def distances(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return to_centroids(points[:, :cut], self.first), to_centroids(points[:, cut:], self.second)

    def cells(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one, two = self.distances(points)
        return one.argmin(1), two.argmin(1)


def walk(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, enough: float):
    """Non-empty cells (i, j) in order of one[i] + two[j], until they hold ``enough`` entries."""
    order1, order2 = one.argsort(kind="stable"), two.argsort(kind="stable")
    low1, low2 = one[order1].tolist(), two[order2].tolist()
    heap, done, found, cells = [(low1[0] + low2[0], 0, 0)], {}, 0, []
    while heap and found < enough:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1  # cells of a row come in order
        a, b = order1[i], order2[j]
        if sizes[a, b]:
            cells.append((int(a), int(b)))
            found += sizes[a, b]
        if i + 1 < len(low1) and done.get(i + 1, 0) == j:
            heapq.heappush(heap, (low1[i + 1] + low2[j], i + 1, j))
        if j + 1 < len(low2) and (i == 0 or done.get(i - 1, 0) > j + 1):
            heapq.heappush(heap, (low1[i] + low2[j + 1], i, j + 1))
    return cells


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean lengths. Rows whose squares leave the range of doubles are scaled first."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        squares = (vectors ** 2).sum(1)
        d = np.sqrt(squares)
        odd = np.flatnonzero(~((squares >= SQUARES[0]) & (squares <= SQUARES[1])))
        if len(odd):
            top = np.abs(vectors[odd]).max(axis=1, initial=0.0)
            scale = np.where((top > 0) & np.isfinite(top), top, 1.0)
            d[odd] = np.where(np.isfinite(top), scale * np.sqrt(((vectors[odd] / scale[:, None]) ** 2).sum(1)), np.inf)
    return d


def nearest(entries: np.ndarray, ids: np.ndarray, query: np.ndarray, k: int):
    """Positions and distances of the k nearest, ties by id."""
    with np.errstate(over="ignore"):
        d = lengths(entries - query)
    if len(d) > k:
        at = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
    else:
        at = np.arange(len(d))
    at = at[np.lexsort((ids[at], d[at]))][:k]
    return at, d[at]


class MultiIndex:
    """Centroids, cell sizes and the share of entries to walk are small; entries are a table
    (c1, c2, vec_id, vec) in the shared folder."""

    def __init__(self, df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
                 recall: float = RECALL):
        self.k, self.vectors = k, usable(df, id_col, vec_col)
        self.kind = self.vectors.schema["vec"].dataType.simpleString()
        self.total = self.vectors.count()
        if not self.total:
            return
        sample = least_by_hash(self.vectors, "vec_id", SAMPLE, self.total).toArrow()
        points = matrix(sample["vec"])
        cut, n = max(1, points.shape[1] // 2), max(1, int(len(points) ** 0.5))
        self.halves = Halves(centroids_of(points[:, :cut], n), centroids_of(points[:, cut:], n))
        self.entries = self._cells()
        self.sizes = np.zeros((len(self.halves.first), len(self.halves.second)), np.int64)
        for r in self.entries.groupBy("c1", "c2").count().collect():  # SAMPLE rows at most
            self.sizes[r["c1"], r["c2"]] = r["count"]
        self.enough = self._measured(points[:PROBES], sample["vec_id"].to_numpy()[:PROBES], recall)

    def _cells(self) -> DataFrame:
        halves = self.halves

        def assign(batches):
            for batch in batches:
                one, two = halves.cells(matrix(batch.column("vec")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one, pa.int32()), pa.array(two, pa.int32()), batch.column("vec_id"),
                     batch.column("vec")], ["c1", "c2", "vec_id", "vec"])

        return written(self.vectors.select("vec_id", "vec").mapInArrow(
            assign, f"c1 int, c2 int, vec_id bigint, vec {self.kind}"), "cells")

    def _measured(self, probes: np.ndarray, probe_ids: np.ndarray, recall: float) -> int:
        """Entries to walk until ``recall`` of the sample queries' true neighbours have been met."""
        k = self.k

        def best(batches):
            for batch in batches:
                ids, points = batch.column("vec_id").to_numpy(), matrix(batch.column("vec"))
                c1, c2 = batch.column("c1").to_numpy(), batch.column("c2").to_numpy()
                for q, (query, own) in enumerate(zip(probes, probe_ids)):
                    at, d = nearest(points, ids, query, k + 1)
                    keep = ids[at] != own
                    at, d = at[keep], d[keep]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (np.full(len(at), q), ids[at], c1[at], c2[at], d)],
                        ["q", "vec_id", "c1", "c2", "d"])

        rank = F.row_number().over(Window.partitionBy("q").orderBy("d", "vec_id"))
        rows = (self.entries.mapInArrow(best, "q bigint, vec_id bigint, c1 int, c2 int, d double")
                .withColumn("rank", rank).where(F.col("rank") <= k).collect())  # PROBES * k rows
        one, two = self.halves.distances(probes)
        needed = []
        for q in range(len(probes)):
            mine = [r for r in rows if r["q"] == q]
            if mine:
                sums = (one[q][:, None] + two[q]).ravel()
                order = sums.argsort(kind="stable")
                met = np.empty(len(order), np.int64)
                met[order] = self.sizes.ravel()[order].cumsum()
                needed += [met[r["c1"] * self.sizes.shape[1] + r["c2"]] for r in mine]
        goal = int(np.quantile(needed, recall, method="higher")) if needed else self.total
        return max(goal, 10 * (k + 1))

    def search(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score): the k nearest found of each query (vec_id, vec), itself left
        out; all of them if there are fewer. ``queries`` are rows of :attr:`vectors`."""
        spark, k = queries.sparkSession, self.k
        if not self.total:
            return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
        halves, sizes, enough = self.halves, self.sizes, self.enough

        def visits(batches):
            for batch in batches:
                vecs = batch.column("vec")
                one, two = halves.distances(matrix(vecs))
                rows: list[tuple] = []
                for i, query in enumerate(batch.column("vec_id").to_pylist()):
                    by_first: dict[int, list[int]] = {}
                    for a, b in walk(one[i], two[i], sizes, enough):
                        by_first.setdefault(a, []).append(b)
                    rows += [(i, query, a, bs) for a, bs in by_first.items()]
                    if len(rows) >= ENTRIES or i == len(one) - 1:
                        at = pa.array([r[0] for r in rows], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([r[1] for r in rows], pa.int64()),
                             pa.array([r[2] for r in rows], pa.int32()),
                             pa.array([r[3] for r in rows], pa.list_(pa.int32())), vecs.take(at)],
                            ["query_id", "c1", "c2s", "vec"])
                        rows = []

        def rank_block(key, entries: pa.Table, asking: pa.Table) -> pa.Table:
            ids, c2 = entries["vec_id"].to_numpy(), entries["c2"].to_numpy()
            points, wanted = matrix(entries["vec"]), matrix(asking["vec"])
            out = ([], [], [])
            for query, vec, cells in zip(asking["query_id"].to_pylist(), wanted,
                                         asking["c2s"].to_pylist()):
                open_ = np.zeros(sizes.shape[1], bool)
                open_[cells] = True
                at = np.flatnonzero(open_[c2] & (ids != query))
                best, d = nearest(points[at], ids[at], vec, k)
                out[0].append(np.full(len(best), query))
                out[1].append(ids[at][best])
                out[2].append(d)
            kinds = (pa.int64(), pa.int64(), pa.float64())
            return pa.table([pa.array(np.concatenate(x) if x else [], t) for x, t in zip(out, kinds)],
                            ["query_id", "vec_id", "score"])

        asked = written(queries.select("vec_id", "vec").mapInArrow(
            visits, f"query_id bigint, c1 int, c2s array<int>, vec {self.kind}"), "visits")
        # A block is some entries of one first centroid against some of the queries that visit it.
        held = self.entries.groupBy("c1").count().select("c1", F.ceil(
            F.col("count") / ENTRIES).cast("int").alias("parts"))
        asking = asked.groupBy("c1").count().select("c1", F.ceil(
            F.col("count") / QUERIES).cast("int").alias("turns"))
        cut = F.broadcast(held.join(asking, "c1"))  # a row per first centroid
        entries = (self.entries.join(cut, "c1")
                   .withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts"))
                   .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
                   .withColumn("turn", F.col("turn").cast("bigint")).drop("parts", "turns"))
        queries_ = (asked.join(cut, "c1")
                    .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
                    .withColumn("part", F.col("part").cast("bigint"))
                    .withColumn("turn", F.pmod(F.xxhash64("query_id"), "turns")).drop("parts", "turns"))
        keys = ["c1", "part", "turn"]
        found = (entries.groupBy(*keys).cogroup(queries_.groupBy(*keys))
                 .applyInArrow(rank_block, "query_id bigint, vec_id bigint, score double"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return (found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))


def neighbours(df: DataFrame, every: int, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10
               ) -> DataFrame:
    """The k nearest of every vector whose id is divisible by ``every``, among all others.

    Vectors that are null, all zero, or hold null or non-finite components take no part, nor do ones of
    another length than most. Repeated rows of an id count once. Ties go to the smaller id. An empty table gives
    an empty result. Centroids are fitted on at most ``SAMPLE`` vectors; every vector is indexed.
    """
    index = MultiIndex(df, id_col, vec_col, k)
    return index.search(index.vectors.where(F.col("vec_id") % every == 0))
