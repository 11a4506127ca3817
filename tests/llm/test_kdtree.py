import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataframe.llm import kdtree

ROWS = "vec_id long, embedding array<float>, extra string"


def plain(rows, k, queries):
    good = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (q, u) in enumerate(good):
        if q is not None and queries(q):
            found = sorted((-sum(x * y for x, y in zip(u, v, strict=True)), i) for b, (i, v) in enumerate(good) if a != b and len(u) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


@given(st.integers(1, 300), st.integers(1, 12), st.integers(0, 4))
@settings(max_examples=40, deadline=None)
def test_search_is_exact(n, dim, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-5, 6, (n, dim)) if seed % 2 else rng.integers(-(1 << 29), 1 << 29, (n, dim))
    tree = kdtree.Tree(vectors, leaf=7)
    ids, keys = rng.permutation(n), np.arange(n)
    got = kdtree.search(tree, ids, keys, vectors, keys, np.full(n, -np.inf), 5)
    scores = vectors.astype(object) @ vectors.astype(object).T
    for i in range(n):
        want = sorted(((-int(scores[i, j]), int(ids[j])) for j in range(n) if j != i))[:5]
        assert sorted((-s, int(ids[r])) for q, r, s in got if q == i) == want


def test_nodes_have_tight_boxes():
    vectors = np.random.default_rng(0).integers(-9, 9, (500, 6))
    tree = kdtree.Tree(vectors, leaf=16)
    for node in range(len(tree.begin)):
        rows = tree.vectors[tree.begin[node]:tree.end[node]]
        assert (rows.min(0) == tree.lows[node]).all() and (rows.max(0) == tree.highs[node]).all()
        assert tree.left[node] >= 0 or len(rows) <= 16 or (rows == rows[0]).all()


@pytest.mark.parametrize("shard", [8192, 30])
def test_table_with_odd_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(0, 0.3, 8).astype(np.float32).tolist()) for i in range(200)]
    rows += [(250, rows[0][1]), (250, rows[0][1]), (300, None), (350, [1.0, None]), (400, [float("nan")] * 8), (450, [float("inf")] * 8),
             (500, [0.5, 0.25]), (501, [0.5, -0.25]), (550, []), (None, rows[1][1]), (None, [0.9] * 8), (602, [0.9] * 8), (600, [0.1] * 8), (601, [0.1] * 8)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], ROWS)
    vectors = table.select("vec_id", kdtree.quantised("embedding").alias("vector"))
    got = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in kdtree.top_k(vectors, F.col("vec_id") % 50 == 0).collect()), key=str)
    last = 10 ** 9  # where null ids stand among ties
    want = plain([(last if i is None else i, v) for i, v in rows], 5, lambda q: q % 50 == 0 and q != last)
    assert got == sorted(((q, r, None if i == last else i, s) for q, r, i, s in want), key=str)
    assert any(r[2] is None for r in got)


def test_empty_table(spark):
    table = spark.createDataFrame([], ROWS).select("vec_id", kdtree.quantised("embedding").alias("vector"))
    assert kdtree.top_k(table, F.col("vec_id") % 50 == 0).count() == 0


def test_clustered_queries_reach_few_shards(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(kdtree, "QUERY_ROWS", 7)
    monkeypatch.setattr(kdtree, "BOX_ROWS", 4)
    rng = np.random.default_rng(2)
    centres = rng.normal(0, 1, (12, 8))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.01, 8)).tolist()) for i in range(1200)]
    rows += [(5000 + i, [0.5] * 8) for i in range(400)]  # copies of one vector: a cell of several shards
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], ROWS)
    vectors = table.select("vec_id", kdtree.quantised("embedding").alias("vector"))
    trees, reached = kdtree.planted(vectors, F.col("vec_id") % 50 == 0, 5, "vec_id", "vector")
    shards, pairs, queries = trees.count(), reached.count(), len([i for i, _ in rows if i % 50 == 0])
    assert shards >= 30
    assert trees.selectExpr("max(size(key))").first()[0] <= 100
    assert pairs <= shards * queries / 3
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in kdtree.top_k(vectors, F.col("vec_id") % 50 == 0).collect())
    assert got == plain(rows, 5, lambda q: q % 50 == 0)


def test_trees_are_read_back():
    vectors = np.random.default_rng(3).integers(-9, 9, (300, 5))
    tree = kdtree.Tree(vectors, leaf=16)
    again = kdtree.Tree.of(300, 5, tree.parts())
    assert all((getattr(tree, a) == getattr(again, a)).all() for a in ("vectors", "begin", "end", "left", "right", "lows", "highs"))
