import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, asks, k):
    fine = [(i, [float(np.float32(x)) for x in v]) for i, v, _ in rows
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(fine):
        if not asks(i):
            continue
        found = []
        for b, (j, w) in enumerate(fine):
            if a != b and len(v) == len(w):
                dot = na = nb = 0.0
                for x, y in zip(v, w):
                    dot, na, nb = dot + x * y, na + x * x, nb + y * y
                found.append((-(dot / (math.sqrt(na) * math.sqrt(nb))), j is None, j or 0, j))
        found.sort(key=lambda x: x[:3])
        out += [(i, r + 1, j, -s) for r, (s, _, _, j) in enumerate(found[:k])]
    return sorted(out, key=str)


def got(spark, rows, k=5, every=50):
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = neighbours.nearest(df, F.col("vec_id") % every == 0, k)
    return sorted((tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_all_neighbours_over_many_blocks(spark, monkeypatch):
    """Isotropic and clustered vectors, a third of all rows copies of one, some scaled or opposite copies; recall is 1."""
    for name, rows in (("BLOCK_ROWS", 90), ("ASKING_ROWS", 20), ("TILE_ROWS", 32)):
        monkeypatch.setattr(neighbours, name, rows)
    rng = np.random.default_rng(1)
    vectors = np.concatenate([rng.normal(size=(200, 24)), rng.normal(size=(1, 24)) + rng.normal(size=(150, 24)) / 50,
                              np.repeat(rng.normal(size=(1, 24)), 250, 0)])
    vectors[5], vectors[6], vectors[7] = vectors[4] * 2, -vectors[4], vectors[4] * 1e-20
    rows = [(i, [float(x) for x in np.float32(v)], 0) for i, v in enumerate(vectors[rng.permutation(len(vectors))])]
    assert got(spark, rows, every=7) == plain(rows, lambda i: i % 7 == 0, 5)


@pytest.mark.parametrize("k", [1, 3, 9])
def test_odd_rows(spark, k):
    """Null, empty, zero and non-finite vectors, null and repeated ids, other lengths, fewer candidates than k, ties."""
    rows = [(0, [1.0, 0.0], 1), (50, [1.0, 0.0], 1), (1, [2.0, 0.0], None), (2, [0.0, 3.0], 1), (3, [-1.0, 0.0], 1), (None, [1.0, 0.0], 1),
            (100, [1.0, 0.0, 0.0], 1), (101, [1.0, 1.0, 0.0], 1), (150, [7.0], 1), (200, None, 1), (250, [], 1), (300, [0.0, 0.0], 1), (4, [-0.0, 1.0], 1),
            (350, [None, 1.0], 1), (400, [float("nan"), 1.0], 1), (5, [float("inf"), 1.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (None, [3.0, 3.0], 2)]
    assert got(spark, rows, k) == plain(rows, lambda i: i is not None and i % 50 == 0, k)


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1)], SCHEMA)
    for name in ("id", "vector", "key", "asks", "cls", "members", "score", "rank"):
        df = df.withColumn(name, F.lit("x"))
    assert [tuple(r) for r in neighbours.nearest(df, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 1.0)]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") == 0, 5).collect() == []


@pytest.mark.parametrize("dim", [1, 3, 64, 1100])
def test_bounds_hold_and_cut(dim):
    rng = np.random.default_rng(dim)
    vectors = rng.normal(size=(80, dim)) * 10.0 ** rng.integers(-18, 18, (80, 1))
    codes, scale, miss = neighbours.code(vectors)
    ids = np.arange(80)
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    true = unit @ unit.T
    for k in (1, 80):
        i, j, low, high = (np.concatenate(x) for x in zip(*neighbours.tile_pairs((ids, codes, scale, miss), (ids, codes, scale, miss), k)))
        assert (low <= true[i, j]).all() and (true[i, j] <= high).all() and len(i) <= 80 * 79
        if k == 80:
            assert len(i) == 80 * 79
        elif dim == 64:
            assert len(i) < 80 * 8
