"""Nearest neighbours by counting collisions in sorted single projections.

Every vector is projected on ``PROJECTIONS`` random directions, and a block of rows keeps one
sorted array of values per direction. A query opens a window around its own value in each
array, ``WIDTH`` times a radius to either side. A row at that distance or nearer is inside a
window with at least the chance that a normal number is below ``WIDTH``, so its count of
collisions reaches the ``threshold`` but for a chance of ``MISS``; rows that reach it are verified
by their whole vectors. Radii grow by ``GROWTH`` (virtual rehashing: only the rings that a
window gains are counted) until the k-th best row found is nearer than the radius. The best
rows are carried from block to block, so later blocks start near the final radius; the first
rows of a cell are verified outright, to know where to begin. Every row of the table is
indexed and none is left out of the counting.

Nearness is the inner product. Vectors are divided by the largest norm of all and get one more
component that makes them unit vectors, queries are made unit vectors; then the order
by distance is the order by inner product. Scores are sums of products in the order of
the components, in doubles, from the vectors as they are.

Defined cases: rows without an id or a vector, with a null or non-finite component, with a zero
vector, or whose length is not the most frequent one take no part. Equal rows are one row. Of
rows that share an id but not the vector each is a candidate; as a query the least of them
counts, and rows with its own id are not its candidates. Ties go to the smaller id. An empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from math import comb, erf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage
from .textwords import read_table
from .vector_blocks import Block, Stats, finite_vectors, search_blocks, stats_of

PROJECTIONS = 48
WIDTH = 1.0
MISS = 0.1
GROWTH = 1.08
#: Queries that a task holds.
GROUP = 512
#: Rows of a cell that are verified outright.
SEEDS = 128


def threshold(projections: int, width: float, miss: float) -> int:
    """The largest count that a row within the radius misses with at most ``miss``."""
    p = erf(width / 2 ** 0.5)
    below = 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def directions(size: int, projections: int) -> np.ndarray:
    """Random directions, the same in every task."""
    return np.random.default_rng(20_231).standard_normal((size, projections))


class CollisionSearch:
    """The best ``k`` rows of each query of a group, over the blocks shown so far."""

    def __init__(self, queries: Block, k: int, stats: Stats, projections: int = PROJECTIONS,
                 width: float = WIDTH, miss: float = MISS):
        self.k, self.norm, self.width = k, stats.norm, width
        self.least = threshold(projections, width, miss)
        self.ids, self.queries = queries.ids, queries.vectors
        self.lengths = np.linalg.norm(self.queries, axis=1)
        self.axes = directions(stats.size + 1, projections)
        self.at = (self.queries / self.lengths[:, None]) @ self.axes[:-1]
        n = len(self.ids)
        self.best_ids = [np.zeros(0, np.int64)] * n
        self.best_scores = [np.zeros(0)] * n
        self.verified = 0

    def farthest(self, q: int) -> float:
        """Distance of the k-th best row; infinite until there are that many."""
        scores = self.best_scores[q]
        if len(scores) < self.k:
            return np.inf
        return max(0.0, 2 - 2 * scores[-1] / (self.lengths[q] * self.norm)) ** 0.5

    def verify(self, q: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.verified += len(ids)
        v = self.queries[q]
        scores = vectors @ v
        kept = self.best_scores[q]
        able = ids != self.ids[q]
        if len(kept) == self.k:  # the product above may differ in its last bits
            able &= scores >= kept[-1] - 1e-9 * self.lengths[q] * self.norm
        able = np.flatnonzero(able)
        if not len(able):
            return
        exact = np.zeros(len(able))
        for x, y in zip(vectors[able].T, v, strict=True):
            exact += x * y
        ids = np.concatenate([self.best_ids[q], ids[able]])
        scores = np.concatenate([kept, exact])
        order = np.lexsort((ids, -scores))[:self.k]
        self.best_ids[q], self.best_scores[q] = ids[order], scores[order]

    def block(self, rows: Block) -> None:
        ids, vectors = rows.ids, rows.vectors
        fresh = [q for q in range(len(self.ids)) if len(self.best_ids[q]) < self.k]
        seeds = SEEDS if fresh else 0
        for q in fresh:
            self.verify(q, ids[:seeds], vectors[:seeds])
        ids, vectors = ids[seeds:], vectors[seeds:]
        n = len(ids)
        if not n:
            return
        unit = vectors / self.norm
        last = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", unit, unit)))
        values = (unit @ self.axes[:-1] + last[:, None] * self.axes[-1]).T
        order = np.argsort(values, axis=1)
        values = np.take_along_axis(values, order, axis=1)

        m = len(values)
        active = np.arange(len(self.ids))
        radius = np.array([min(self.farthest(q), 2.0) / GROWTH for q in active])
        counts: list = [None] * len(active)
        low = high = None
        while len(active):
            reach = self.width * radius[active]
            at = self.at[active]
            now_low = np.stack([np.searchsorted(values[j], at[:, j] - reach) for j in range(m)], 1)
            now_high = np.stack([np.searchsorted(values[j], at[:, j] + reach, "right")
                                 for j in range(m)], 1)
            if low is None:
                low = high = now_low
            goes_on = np.zeros(len(active), bool)
            for i, q in enumerate(active):
                rings = [order[j, a:b] for j in range(m) for a, b in
                         ((now_low[i, j], low[i, j]), (high[i, j], now_high[i, j])) if a < b]
                if rings:
                    gained = np.bincount(np.concatenate(rings), minlength=n)
                    before = counts[q]
                    now = gained if before is None else before + gained
                    new = now >= self.least
                    if before is not None:
                        new &= before < self.least
                    counts[q] = now.astype(np.int16)
                    new = np.flatnonzero(new)
                    self.verify(q, ids[new], vectors[new])
                goes_on[i] = self.farthest(q) > radius[q]
                if goes_on[i] and radius[q] >= 2:  # no distance is larger
                    goes_on[i] = False
                    if len(self.best_ids[q]) < self.k:
                        rest = slice(None) if counts[q] is None else counts[q] < self.least
                        self.verify(q, ids[rest], vectors[rest])
            active, low, high = active[goes_on], now_low[goes_on], now_high[goes_on]
            radius[active] = np.minimum(2.0, radius[active] * GROWTH)

    def results(self) -> pa.RecordBatch:
        sizes = [len(b) for b in self.best_ids]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.ids, sizes)), pa.array(np.concatenate(self.best_ids)),
            pa.array(np.concatenate(self.best_scores))], ["query_id", "vec_id", "score"])


def nearest(df: DataFrame, id_col: str, vector: str, is_query: Column, k: int,
            projections: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the ``k`` nearest rows found for each row that
    ``is_query`` marks."""
    rows = cut_lineage(finite_vectors(df, id_col, vector, asked=F.coalesce(is_query, F.lit(False))))
    rows = rows.where(F.exists("vec", lambda x: x != 0))
    stats = stats_of(rows) or Stats(1, 0, 1.0)
    rows = rows.where(F.size("vec") == stats.size)
    asked = cut_lineage(rows.where("asked").groupBy("id").agg(F.min("vec").alias("vec")))
    found = search_blocks(
        asked, asked.count(), rows.drop("asked"), stats.rows,
        lambda group: CollisionSearch(group, k, stats, projections, width, miss),
        "query_id long, vec_id long, score double", GROUP)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query()
def op12_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding",
                   F.col("vec_id") % 20 == 0, 20)
