import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millstream.llm import anchor_tree, collision_search, vector_blocks
from millstream.llm.anchor_tree import hard_negatives, op13_anchor_tree, spanning_tree
from millstream.llm.collision_search import nearest, op12_collision_search, threshold

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = math.nan, math.inf
#: 0 is a query and an anchor. 20 and 40 are equal vectors, 60 a repeated row, 80 an id with two vectors.
AWKWARD = [
    (0, [1.0, 0.5, 0.0], 1), (20, [0.5, 0.5, 0.5], 1), (40, [0.5, 0.5, 0.5], 1),
    (60, [0.9, 0.1, 0.0], 2), (60, [0.9, 0.1, 0.0], 2), (80, [0.1, 0.2, 0.3], 3),
    (80, [0.3, 0.2, 0.1], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1),
    (4, [1.0, None, 2.0], 1), (5, [1.0, NAN, 2.0], 1), (6, [1.0, INF, 2.0], 1),
    (None, [1.0, 1.0, 1.0], 1), (8, [1.0, 1.0], 1), (9, [-1.0, -1.0, -1.0], 2),
    (10, [2.0, 0.0, 0.0], None), (11, [0.6, 0.6, 0.0], 2), (-100, [0.2, 0.9, 0.1], 2),
    (12, [1e30, 0.0, 0.0], 2),
]


def write(spark, rows, path, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    df.select("*", *[F.lit(1).alias(c) for c in ("id", "vec", "rank", "score", "cell", "side",
                                                 "asked", "anchor")]).repartition(3).write.parquet(
        f"{path}/embeddings.parquet")
    return str(path)


def usable(rows):
    return {(i, tuple(v)): lab for i, v, lab in rows
            if i is not None and v and len(v) == 3 and all(x is not None and math.isfinite(x)
                                                           for x in v)}


def clustered(n, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, 16))
    vectors = centres[rng.integers(0, 8, n)] + rng.standard_normal((n, 16))
    vectors = vectors * scale * rng.uniform(0.2, 3, (n, 1))
    return [(i, v.astype(np.float32).tolist(), int(lab)) for i, (v, lab) in
            enumerate(zip(vectors, rng.integers(0, 10, n), strict=True))]


def test_threshold_is_the_lower_quantile():
    rng = np.random.default_rng(0)
    inside = (np.abs(rng.standard_normal((20000, 48))) < 1.0).sum(axis=1)
    t = threshold(48, 1.0, 0.1)
    assert (inside < t).mean() <= 0.105 < (inside < t + 1).mean() + 0.01


def test_awkward_vectors_have_all_their_neighbours(spark, tmp_path):
    rows = [(i, v and [np.float32(x).item() if x is not None else None for x in v], lab)
            for i, v, lab in AWKWARD]
    path = write(spark, rows, tmp_path)
    every = {k for k in usable(rows) if any(k[1])}
    want = []
    for q in (0, 20, 40, 60, 80, -100):
        v = min(vec for i, vec in every if i == q)
        near = sorted((-sum(a * b for a, b in zip(v, vec, strict=True)), i)
                      for i, vec in every if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(near[:20], 1)]
    got = op12_collision_search(spark, path)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_search_of_an_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nearest(none, "vec_id", "embedding", F.lit(True), 3).count() == 0
    assert hard_negatives(none, "vec_id", "embedding", F.col("label"), F.lit(True)).count() == 0


@pytest.mark.parametrize("source", ["sf0.1", "norms"])
def test_recall_against_brute_force(spark, tmp_path, source, monkeypatch):
    monkeypatch.setattr(collision_search, "GROUP", 64)
    if source == "norms":
        path = write(spark, clustered(3000, 5), tmp_path)
    else:
        path = f"/root/testdata/{source}"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    got = {}
    for r in op12_collision_search(spark, path).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    asked = ids[ids % 20 == 0]
    assert sorted(got) == sorted(asked)
    for q in asked:
        found = sorted(got[q])
        scores = vectors @ vectors[ids == q][0]
        assert [f[0] for f in found] == list(range(1, 21))
        assert np.allclose([scores[ids == f[1]][0] for f in found], [f[2] for f in found],
                           rtol=1e-12, atol=1e-12)
        assert [(-f[2], f[1]) for f in found] == sorted((-f[2], f[1]) for f in found)
        scores[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -scores))[:20]]
        hits += len(set(best) & {f[1] for f in found})
    assert hits >= 0.93 * 20 * len(asked)


def test_tree_spans_with_the_least_edges():
    rng = np.random.default_rng(1)
    v = rng.standard_normal((40, 5))
    order, parent, edges = spanning_tree(v)
    assert sorted(order) == list(range(40)) and parent[0] == -1
    seen = set()
    for a in order:
        assert parent[a] in seen or a == 0
        seen.add(a)
    # Kruskal's total
    total, root = 0.0, list(range(40))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for d, i, j in sorted((np.linalg.norm(v[i] - v[j]), i, j) for i in range(40) for j in range(i)):
        if top(i) != top(j):
            root[top(i)] = top(j)
            total += d
    assert edges.sum() == pytest.approx(total)


def plain_negatives(rows):
    every = []
    for (i, v), lab in usable(rows).items():
        if lab is not None and all(abs(256 * x) < 1e9 for x in v):
            every.append((i, [math.floor(256 * x) for x in v],
                          (lab + 1) % 10 if i % 7 == 0 else lab))
    out = []
    for a in {i for i, _, _ in every if i % 100 == 0}:
        v, lab = min((v, lab) for i, v, lab in every if i == a)
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other == lab)
                        for i, w, other in every if i != a)
        for ps, p in [(s, i) for s, i, same in scored if same][:5]:
            near = [(s, i) for s, i, same in scored if not same and -80 * ps <= -100 * s <= -100 * ps]
            out += [(a, p, r, i, -ps, -s) for r, (s, i) in enumerate(near[:5], 1)]
    return sorted(out)


def test_negatives_of_awkward_rows(spark, tmp_path):
    rows = [(i, v and [np.float32(x).item() if x is not None else None for x in v], lab)
            for i, v, lab in AWKWARD]
    got = op13_anchor_tree(spark, write(spark, rows, tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    want = plain_negatives(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and want


@pytest.mark.parametrize("scale", [1.0, 1e4])
def test_negatives_equal_brute_force(spark, tmp_path, scale, monkeypatch):
    """With the larger scale the products of components need integers."""
    monkeypatch.setattr(anchor_tree, "GROUP", 4)
    rows = [(i, v[:3], lab) for i, v, lab in clustered(1200, 7, scale)]
    got = op13_anchor_tree(spark, write(spark, rows, tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(rows)


def test_close_anchors_spare_scores():
    rng = np.random.default_rng(2)
    base = rng.integers(-200, 200, 24)
    anchors = base + rng.integers(-2, 3, (30, 24))
    rows = rng.integers(-200, 200, (4000, 24))
    import pyarrow as pa
    lab = pa.array(np.zeros(30, np.int64))
    search = anchor_tree.Positives(vector_blocks.Block(
        np.arange(30), anchors.astype(float), {"label": lab}), 5)
    for part in np.split(np.arange(4000), 4):
        search.block(vector_blocks.Block(part + 100, rows[part].astype(float),
                                         {"label": pa.array(np.zeros(1000, np.int64))}))
    scores = anchors @ rows.T
    for a in range(30):
        want = np.lexsort((np.arange(4000), -scores[a]))[:5]
        assert search.best[a][0].tolist() == (want + 100).tolist()
    assert search.scored < 0.6 * 30 * 4000
