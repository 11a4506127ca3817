"""Exact top-k inner products with a KD-tree in every shard.

Shards are spatial: median splits of the widest component, fitted on a bounded sample of the vectors, deal
every vector into a cell; a cell with more vectors than a shard holds (copies of one vector, say) is dealt
on by a hash. Each shard builds one tree, which is written: it splits at the median of the widest component
and keeps a tight bounding box in each node. The largest inner product that a box allows bounds its node; queries visit nodes
best bound first, and stop when their kth score so far is greater than all bounds left. Queries at the same leaf are scored by one
matrix product. Queries search their own shard first; with the kth score found there a query only goes to
shards whose root box reaches it, and prunes from the start. Scores must fit into longs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import written

#: Vectors of a shard and queries of a block, on average; vectors of a leaf; boxes that queries meet at once.
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS, BOX_ROWS = 8192, 4096, 64, 32
#: Components of a shard's vectors and of a block's queries, on average (long vectors make shards of fewer rows).
VALUES = 1 << 19
#: Vectors, and components of them, that the cells are fitted on; the least sampled vectors of a cell.
SAMPLE_ROWS, SAMPLE_VALUES, CELL_ROWS = 16_384, 1 << 23, 16
#: Scores of one matrix product; queries of one search step.
PRODUCT, STEP = 1 << 22, 1024
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)


def quantised(vector: str | Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component x, as longs. Null for vectors that are null or hold null or
    non-finite components."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


class Tree:
    """Rows of a matrix in order of the leaves, with the nodes' row ranges, boxes and children."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF_ROWS):
        self.order = np.arange(len(vectors))
        begin, end, lows, highs, left, right = [], [], [], [], [], []
        todo = [(0, len(vectors), None, None)] if len(vectors) else []
        while todo:
            a, b, parent, side = todo.pop()
            rows = vectors[self.order[a:b]]
            low, high = rows.min(0), rows.max(0)
            node = len(begin)
            if parent is not None:
                side[parent] = node
            for values, value in ((begin, a), (end, b), (lows, low), (highs, high), (left, -1), (right, -1)):
                values.append(value)
            if b - a > leaf and vectors.shape[1] and (high > low).any():
                widest, half = int(np.argmax(high - low)), (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(rows[:, widest], half)]
                todo += [(a + half, b, node, right), (a, a + half, node, left)]
        self.vectors = vectors[self.order]
        self.begin, self.end, self.left, self.right = (np.array(v, np.int64) for v in (begin, end, left, right))
        self.lows, self.highs = (np.array(v, np.int64).reshape(len(begin), vectors.shape[1]) for v in (lows, highs))

    def parts(self) -> list[bytes]:
        """The arrays of the tree, but for ``order``."""
        return [np.ascontiguousarray(v).tobytes() for v in (self.vectors, self.begin, self.end, self.left, self.right, self.lows, self.highs)]

    @classmethod
    def of(cls, rows: int, dim: int, parts: list[bytes]) -> Tree:
        """The tree of these parts, whose rows are numbered in order of its leaves."""
        tree = cls.__new__(cls)
        vectors, tree.begin, tree.end, tree.left, tree.right, lows, highs = (np.frombuffer(p, np.int64) for p in parts)
        tree.order, tree.vectors = np.arange(rows), vectors.reshape(rows, dim)
        tree.lows, tree.highs = (v.reshape(len(tree.begin), dim) for v in (lows, highs))
        return tree


def _bounds(queries: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """The largest inner product of each query (row) that each box (column) allows, or a little more."""
    q, low, high = queries.astype(float), lows.astype(float), highs.astype(float)
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    return bounds + 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T)


def _floor(scores: np.ndarray) -> np.ndarray:
    """Scores as doubles, or a little less."""
    scores = np.asarray(scores, float)
    return scores - 1e-12 * np.where(np.isfinite(scores), np.abs(scores), 0)


def _numbers(queries: np.ndarray, tree: Tree) -> np.dtype:
    """Doubles where all inner products are exact in them, else longs."""
    most = float(np.abs(queries).max(initial=0)) * float(max(np.abs(tree.lows).max(initial=0), np.abs(tree.highs).max(initial=0)))
    return np.dtype(np.float64 if most * max(1, queries.shape[1]) < EXACT else np.int64)


def _best(tree: Tree, vectors: np.ndarray, place: np.ndarray, keys: np.ndarray, q: np.ndarray, bounds: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int):
    """(score, row) of the best k rows of each query, as matrices; row is -1 where there is none."""
    least = -np.inf if q.dtype == np.float64 else np.iinfo(np.int64).min + 1
    score, row = np.full((len(q), k), least, q.dtype), np.full((len(q), k), -1)
    waiting = np.full(bounds.shape, -np.inf)  # bounds of the nodes that a query has reached and not visited
    waiting[:, :1] = bounds[:, :1]
    active = np.arange(len(q)) if bounds.shape[1] else np.zeros(0, np.int64)
    while len(active):
        node = waiting[active].argmax(1)
        bound = waiting[active, node]
        go = (bound >= floor[active]) & (bound > -np.inf)
        active, node = active[go], node[go]
        waiting[active, node] = -np.inf
        inner = tree.left[node] >= 0
        for child in (tree.left[node[inner]], tree.right[node[inner]]):
            waiting[active[inner], child] = bounds[active[inner], child]
        at_leaf, leaf = active[~inner], node[~inner]
        by = np.argsort(leaf, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(leaf[by])) + 1).tolist(), len(by)] if len(by) else [0]
        for first, last in itertools.pairwise(cuts):
            a, b = int(tree.begin[leaf[by[first]]]), int(tree.end[leaf[by[first]]])
            step = max(1, PRODUCT // (b - a))
            for s in range(first, last, step):
                g = at_leaf[by[s:min(s + step, last)]]
                found = q[g] @ vectors[a:b].T
                use = (found >= floor[g][:, None]) & (keys[a:b] != own[g][:, None])
                hit = use.any(1)
                g, found, use = g[hit], found[hit], use[hit]
                scores = np.concatenate([score[g], np.where(use, found, least)], 1)
                rows = np.concatenate([row[g], np.where(use, np.arange(a, b), -1)], 1)
                pick = np.lexsort((place[rows], -scores, rows < 0))[:, :k]
                score[g], row[g] = np.take_along_axis(scores, pick, 1), np.take_along_axis(rows, pick, 1)
                floor[g] = np.where(row[g][:, -1] >= 0, np.maximum(floor[g], _floor(score[g][:, -1])), floor[g])
    return score, row


def search(tree: Tree, ids: np.ndarray, keys: np.ndarray, queries: np.ndarray, own: np.ndarray, at_least: np.ndarray, k: int):
    """(query, row, score) of the best k rows of each query in the tree, as far as their scores are
    ``at_least`` the query's; row ``own`` (a key) is left out. Order: greater score, then smaller id."""
    kind = _numbers(queries, tree)
    vectors, keys = tree.vectors.astype(kind), keys[tree.order]
    place = np.empty(len(keys), np.int64)
    place[np.argsort(ids[tree.order], kind="stable")] = np.arange(len(keys))
    out = []
    for a in range(0, len(queries) if len(keys) else 0, STEP):
        q = queries[a:a + STEP]
        score, row = _best(tree, vectors, place, keys, q.astype(kind), _bounds(q, tree.lows, tree.highs), own[a:a + STEP], _floor(at_least[a:a + STEP]), k)
        i, j = np.nonzero(row >= 0)
        out += zip((a + i).tolist(), tree.order[row[i, j]].tolist(), (int(s) for s in score[i, j].tolist()), strict=True)
    return out


class Cells:
    """Median splits of the widest components of a sample, down to nodes of ``most`` sampled vectors."""

    def __init__(self, sample: np.ndarray, most: int):
        self.axis, self.cut, self.left, self.right = [], [], [], []
        todo = [(sample, None, None)]
        while todo:
            rows, parent, side = todo.pop()
            node = len(self.axis)
            if parent is not None:
                side[parent] = node
            for values in (self.axis, self.cut, self.left, self.right):
                values.append(-1)
            spread = rows.max(0) - rows.min(0) if rows.size else np.zeros(0)
            if len(rows) > most and (spread > 0).any():
                self.axis[node] = int(np.argmax(spread))
                x = rows[:, self.axis[node]]
                middle = np.sort(x)[len(x) // 2]
                self.cut[node] = int(middle if (x < middle).any() else x[x > middle].min())
                below = x < self.cut[node]
                todo += [(rows[~below], node, self.right), (rows[below], node, self.left)]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell (a leaf's number) of each vector."""
        cell = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.axis[node] < 0 or not len(rows):
                cell[rows] = node
                continue
            below = vectors[rows, self.axis[node]] < self.cut[node]
            todo += [(self.left[node], rows[below]), (self.right[node], rows[~below])]
        return cell


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


def _order(ids: pa.Array) -> np.ndarray:
    """Ids as numbers by which ties are settled; null ids come last."""
    return ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _cells(table: DataFrame, rows: int, dim: int, shard: int) -> DataFrame:
    """``table`` with the spatial cell of each vector. The splits are fitted on the vectors whose keys have the least hashes."""
    size = max(CELL_ROWS, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, dim)))
    sample: dict[int, list] = {}
    for r in table.orderBy(F.xxhash64("key"), "key").limit(size).select("vector").collect() if rows > shard else []:
        sample.setdefault(len(r["vector"]), []).append(r["vector"])
    most = max(CELL_ROWS, min(rows, size) * shard // max(1, rows))
    fitted = {d: Cells(np.array(v, np.int64).reshape(len(v), d), most) for d, v in sample.items()}

    def place(batches):
        for batch in batches:
            dims, cell = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for d in set(dims.tolist()) & set(fitted):
                at = np.flatnonzero(dims == d)
                cell[at] = fitted[d].of(_vectors(batch.column("vector").take(pa.array(at))))
            yield batch.append_column("cell", pa.array(cell))

    return table.mapInArrow(place, "id long, vector array<long>, dim int, asks boolean, key long, cell long")


_TREE = "dim int, cell long, sub long, key array<long>, id array<long>, tree array<binary>, low array<long>, high array<long>, asker array<long>, least array<long>"


def _grow(k: int):
    """The tree of a shard, its root box, and the kth scores of the shard's queries among its vectors."""

    def run(table: pa.Table) -> pa.Table:
        vectors, ids, keys, asks = _vectors(table["vector"]), table["id"].combine_chunks(), table["key"].to_numpy(), table["asks"].to_numpy()
        tree = Tree(vectors)
        result = search(tree, _order(ids), keys, vectors[asks], keys[asks], np.full(int(asks.sum()), -np.inf), k)
        seen = np.bincount([i for i, _, _ in result], minlength=int(asks.sum()))
        least = np.full(len(seen), np.iinfo(np.int64).min)
        for i, _, s in result:
            if seen[i] == k:
                least[i] = s if least[i] == np.iinfo(np.int64).min else min(least[i], s)
        row = [table[c][0].as_py() for c in ("dim", "cell", "sub")]
        row += [keys[tree.order].tolist(), ids.take(pa.array(tree.order)).to_pylist(), tree.parts()]
        row += [tree.lows[0].tolist(), tree.highs[0].tolist(), keys[asks].tolist(), least.tolist()]
        longs = pa.list_(pa.int64())
        kinds = [pa.int32(), pa.int64(), pa.int64(), longs, longs, pa.list_(pa.binary()), longs, longs, longs, longs]
        names = ["dim", "cell", "sub", "key", "id", "tree", "low", "high", "asker", "least"]
        return pa.table([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    return run


_REACHED = "dim int, cell long, sub long, block long, id long, key long, vector array<long>, at_least long"


def _reach(asked: pa.Table, boxes: pa.Table) -> pa.Table:
    """The queries of a block with each shard of a block whose root box reaches their kth scores."""
    if asked.num_rows and boxes.num_rows:
        bounds = _bounds(_vectors(asked["vector"]), _vectors(boxes["low"]), _vectors(boxes["high"]))
        query, box = np.nonzero(bounds >= _floor(asked["at_least"].to_numpy())[:, None])
    else:
        query, box = np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = asked.take(pa.array(query)), boxes.take(pa.array(box))
    names = [c.split()[0] for c in _REACHED.split(", ")]
    return pa.table([(right if c in ("cell", "sub") else left)[c] for c in names], names)


def _rest(k: int):
    def run(asked: pa.Table, trees: pa.Table) -> pa.Table:
        ids, result, keys = pa.array([], pa.int64()), [], np.zeros(0, np.int64)
        if asked.num_rows and trees.num_rows:
            ids, row_keys = (trees[c].combine_chunks().flatten() for c in ("id", "key"))
            tree = Tree.of(len(ids), trees["dim"][0].as_py(), trees["tree"][0].as_py())
            keys = asked["key"].to_numpy()
            result = search(tree, _order(ids), row_keys.to_numpy(), _vectors(asked["vector"]), keys, asked["at_least"].to_numpy(), k)
        at = np.array([(i, r) for i, r, _ in result], np.int64).reshape(-1, 2)
        return pa.table({"query": asked["id"].take(pa.array(at[:, 0])), "query_key": pa.array(keys[at[:, 0]]), "id": ids.take(pa.array(at[:, 1])),
                         "score": pa.array([s for _, _, s in result], pa.int64())})

    return run


def _blocks(number: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(number), F.lit(blocks))


def _each(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))


def planted(rows: DataFrame, queries: Column, k: int, id_col: str, vector_col: str) -> tuple[DataFrame, DataFrame]:
    """The written trees of all shards, and (shard, query block, query) for the shards that queries reach."""
    table = written(rows.where(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), F.size(vector_col).alias("dim"),
        F.coalesce(queries, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("key")), "vectors")
    n, n_queries, dim = table.agg(F.count("*"), F.count_if("asks"), F.coalesce(F.max("dim"), F.lit(0))).first()
    shard, block = (max(1, min(r, VALUES // max(1, dim))) for r in (SHARD_ROWS, QUERY_ROWS))
    cells = _cells(table, n, dim, shard)
    shares = written(cells.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard).alias("parts")), "cells")
    dealt = cells.join(shares, ["dim", "cell"]).withColumn("sub", F.pmod(F.xxhash64("key"), F.col("parts")))
    trees = written(dealt.groupBy("dim", "cell", "sub").applyInArrow(_grow(k), _TREE), "trees")
    blocks = max(1, -(-n_queries // block))
    box_blocks = max(1, -(-trees.count() // BOX_ROWS))
    least = trees.select(F.explode(F.arrays_zip("asker", "least")).alias("of")).select(F.col("of.asker").alias("key"), F.col("of.least").alias("at_least"))
    asked = table.where("asks").join(least, "key").withColumn("block", _blocks(F.col("key"), blocks)).withColumn("boxes", _each(box_blocks))
    roots = (trees.select("dim", "cell", "sub", "low", "high").withColumn("boxes", F.pmod(F.xxhash64("cell", "sub"), F.lit(box_blocks)))
             .withColumn("block", _each(blocks)))
    by = ["dim", "boxes", "block"]
    return trees, written(asked.groupBy(*by).cogroup(roots.groupBy(*by)).applyInArrow(_reach, _REACHED), "reached")


def top_k(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """(query_id, rank, id, score): for each row of ``rows`` that ``queries`` selects the k other rows of
    the greatest inner product, ties to the smaller id; all of them if they are fewer.

    Vectors are arrays of longs. Null vectors take no part. Vectors only meet those of as many components.
    Rows that repeat an id are rows of their own, and each other's candidates. A row without an id is a candidate like any
    other, last among ties, and a query if ``queries`` selects it.
    """
    trees, reached = planted(rows, queries, k, id_col, vector_col)
    by = ["dim", "cell", "sub", "block"]
    copies = trees.select("dim", "cell", "sub", "key", "id", "tree").join(reached.select(*[F.col(c).alias(c) for c in by]).distinct(), by[:3])
    found = reached.groupBy(*by).cogroup(copies.groupBy(*by)).applyInArrow(_rest(k), "query long, query_key long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
