"""Hard negatives, found with score bounds along spanning trees of anchors.

A group of anchors is joined to a minimum spanning tree by the distances of their vectors. For a
block of rows the root's scores are inner products; a child's score of a row differs from its
parent's by at most the length of the edge times the norm of the row. So each row has a lower and
an upper bound for the child, and only rows whose bounds overlap the window of scores that
the child still looks for are scored anew, which makes their bounds exact; the others
pass their wider bounds on. Children are visited depth first, so bounds are held for the
path to the root and no more.

It runs twice: once for the positives (the window is open above the fifth best row of the same
label so far), once for the negatives (between a share of a positive's score and that score).
The best rows so far are carried from block to block and narrow the windows.

Scores are exact: components are whole numbers. Defined cases: rows without an id, a label or a vector,
with a null or non-finite component, with a length that is not the most frequent one, or with
a component so large that a score could leave the range of a long take no part. Equal rows
are one row. Of rows that share an id but not the rest each is a candidate; as an anchor the
least of them counts, and rows with its id are not its candidates. Ties go to the smaller
id. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.registry import query
from ..session import cut_lineage
from .textwords import read_table
from .vector_blocks import Block, Stats, finite_vectors, search_blocks, stats_of

#: Anchors of one tree.
GROUP = 256


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a minimum spanning tree with root 0: the nodes depth first, the parent of each node
    (-1 for the root) and the length of the edge to it."""
    n = len(vectors)
    norms = np.einsum("ij,ij->i", vectors, vectors)
    near = np.full(n, np.inf)
    parent = np.full(n, -1)
    outside = np.ones(n, bool)
    children: list[list[int]] = [[] for _ in range(n)]
    at = 0
    for _ in range(n):
        outside[at] = False
        if parent[at] >= 0:
            children[parent[at]].append(at)
        distance = norms + norms[at] - 2 * (vectors @ vectors[at])
        closer = outside & (distance < near)
        near[closer], parent[closer] = distance[closer], at
        if not outside.any():
            break
        at = int(np.argmin(np.where(outside, near, np.inf)))
    order, stack = [], [0]
    while stack:
        order.append(stack.pop())
        stack += reversed(children[order[-1]])
    edges = np.array([np.linalg.norm(vectors[i] - vectors[parent[i]]) if parent[i] >= 0 else 0.0
                      for i in range(n)])
    return np.array(order), parent, edges


def whole(vectors: np.ndarray) -> np.ndarray:
    """Whole components as doubles where products of them stay exact, else as integers."""
    least = np.abs(vectors).max(initial=0.0)
    return vectors if least ** 2 * vectors.shape[1] < 2.0 ** 52 else vectors.astype(np.int64)


class TreeSearch:
    """Scores of rows inside each anchor's window, over the blocks shown so far. Subclasses
    say which rows an anchor may have, its window, and what is kept."""

    def __init__(self, anchors: Block):
        self.ids, self.vectors = anchors.ids, whole(anchors.vectors)
        self.labels = anchors.more["label"].to_numpy(zero_copy_only=False)
        self.order, self.parent, self.edges = spanning_tree(anchors.vectors)
        self.scored = 0

    def window(self, a: int) -> tuple[float, float]:
        raise NotImplementedError

    def allowed(self, a: int, ids: np.ndarray, labels: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def keep(self, a: int, ids: np.ndarray, scores: np.ndarray) -> None:
        raise NotImplementedError

    def block(self, rows: Block) -> None:
        vectors = whole(rows.vectors)
        if vectors.dtype != self.vectors.dtype:
            vectors = vectors.astype(np.int64)
            self.vectors = self.vectors.astype(np.int64)
        norms = np.linalg.norm(rows.vectors, axis=1) * (1 + 1e-9) + 1e-9
        labels = rows.more["label"].to_numpy(zero_copy_only=False)
        path: list[int] = []
        bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for a in self.order:
            while path and path[-1] != self.parent[a]:
                del bounds[path.pop()]
            least, most = self.window(a)
            if path:
                slack = self.edges[a] * norms
                low, high = bounds[path[-1]][0] - slack, bounds[path[-1]][1] + slack
                near = np.flatnonzero((high >= least) & (low <= most)
                                      & self.allowed(a, rows.ids, labels))
                scores = vectors[near] @ self.vectors[a]
                low[near] = high[near] = scores
            else:
                near = np.arange(len(norms))
                scores = vectors @ self.vectors[a]
                low = high = scores.astype(np.float64)
                fits = self.allowed(a, rows.ids, labels)
                near, scores = near[fits], scores[fits]
            self.scored += len(near)
            path.append(a)
            bounds[a] = low, high
            inside = (scores >= least) & (scores <= most)
            if inside.any():
                self.keep(a, rows.ids[near[inside]], scores[inside].astype(np.int64))


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


class Positives(TreeSearch):
    """The first ``k`` rows of each anchor's label."""

    def __init__(self, anchors: Block, k: int):
        super().__init__(anchors)
        self.k = k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.ids]

    def window(self, a):
        scores = self.best[a][1]
        return (float(scores[-1]) if len(scores) == self.k else -np.inf), np.inf

    def allowed(self, a, ids, labels):
        return (labels == self.labels[a]) & (ids != self.ids[a])

    def keep(self, a, ids, scores):
        old = self.best[a]
        self.best[a] = _first(np.concatenate([old[0], ids]), np.concatenate([old[1], scores]),
                              self.k)

    def results(self) -> pa.RecordBatch:
        sizes = [len(b[0]) for b in self.best]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.ids, sizes)),
            *[pa.array(np.concatenate([b[i] for b in self.best])) for i in (0, 1)]],
            ["anchor_id", "positive_id", "positive_score"])


class Negatives(TreeSearch):
    """For each positive of an anchor the first ``k`` rows of other labels whose score is at most
    the positive's and at least ``share`` hundredths of it."""

    def __init__(self, anchors: Block, k: int, share: int):
        super().__init__(anchors)
        self.k = k
        lists = anchors.more["positives"].to_pylist()
        self.positives = [[(p["id"], p["score"]) for p in (found or [])] for found in lists]
        # the least whole score that is allowed
        self.least = [[-(-share * s // 100) for _, s in found] for found in self.positives]
        none = np.zeros(0, np.int64)
        self.best = [[(none, none) for _ in found] for found in self.positives]

    def window(self, a):
        least = [float(b[1][-1]) if len(b[1]) == self.k else float(low)
                 for b, low in zip(self.best[a], self.least[a], strict=True)]
        return min(least, default=np.inf), max((float(s) for _, s in self.positives[a]),
                                               default=-np.inf)

    def allowed(self, a, ids, labels):
        return (labels != self.labels[a]) & (ids != self.ids[a])

    def keep(self, a, ids, scores):
        for i, (_, most) in enumerate(self.positives[a]):
            fits = (scores <= most) & (scores >= self.least[a][i])
            old = self.best[a][i]
            self.best[a][i] = _first(np.concatenate([old[0], ids[fits]]),
                                     np.concatenate([old[1], scores[fits]]), self.k)

    def results(self) -> pa.RecordBatch:
        rows = [(self.ids[a], *self.positives[a][i], n, s) for a in range(len(self.ids))
                for i, (ids, scores) in enumerate(self.best[a])
                for n, s in zip(ids, scores, strict=True)]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(c, np.int64)) for c in columns],
            ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])


def hard_negatives(df: DataFrame, id_col: str, vector: str, label: Column, is_anchor: Column,
                   scale: float = 256.0, positives: int = 5, negatives: int = 5,
                   share: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for the
    rows that ``is_anchor`` marks; components are ``floor(scale * x)``."""
    rows = finite_vectors(df, id_col, vector, label=label.cast("long"),
                          anchor=F.coalesce(is_anchor, F.lit(False))).where("label is not null")
    stats = stats_of(rows) or Stats(1, 0, 1.0)
    limit = ((2 ** 63 - 1) // stats.size) ** 0.5 - 1
    scaled = F.transform("vec", lambda x: x.cast("double") * scale)
    rows = rows.where(F.size("vec") == stats.size).withColumn("vec", scaled).where(
        F.forall("vec", lambda x: F.abs(x) < limit))
    rows = cut_lineage(rows.withColumn(
        "vec", F.transform("vec", lambda x: F.floor(x).cast("double"))).distinct())
    anchors = cut_lineage(rows.where("anchor").groupBy("id").agg(
        F.min(F.struct("vec", "label")).alias("r")).select("id", "r.vec", "r.label"))
    n, rows = anchors.count(), rows.drop("anchor")
    near = search_blocks(anchors, n, rows, stats.rows,
                         lambda group: Positives(group, positives),
                         "anchor_id long, positive_id long, positive_score long", GROUP)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    near = near.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct(
        F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias(
            "positives"))
    found = search_blocks(
        anchors.join(near, "id"), n, rows, stats.rows,
        lambda group: Negatives(group, negatives, share),
        "anchor_id long, positive_id long, positive_score long, negative_id long, "
        "negative_score long", GROUP)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= negatives).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query(sql="""
    WITH usable AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vec
      FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
    scores AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
      FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER (
             PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INT) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
""")
def op13_anchor_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", label,
                          F.col("vec_id") % 100 == 0)
