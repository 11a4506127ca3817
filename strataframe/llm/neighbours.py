"""Nearest neighbours by cosine: a block matrix join over int8 codes, whose bounds leave few pairs for doubles.

Equal vectors are one class first: only the k + 1 smallest ids of a class can be among anybody's k nearest, as
its rows tie. A class is coded as ``scale`` times a vector of int8, with the length of what the coding leaves
out (``miss``), of the vector scaled to length 1. Blocks of asking classes meet blocks of all classes. A tile is one
product of two int8 matrices; it gives each cosine up to the two vectors' misses. A heap per asking class holds the k
greatest lower bounds that its block has seen, and drops every pair whose upper bound is less. What the blocks let
through is cut once more by the kth lower bound over all blocks, recomputed from the original vectors in doubles, and
merged. The bounds are proven, so the result is exact (recall 1); the codes only save work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.llm.common import written

#: Classes of a block, asking classes of a block, rows of a tile's side.
BLOCK_ROWS, ASKING_ROWS, TILE_ROWS = 8192, 4096, 1024
#: Room in the bounds for the rounding of codes, scales and lengths in doubles.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """The vector as doubles; null if it is null, holds nulls or non-finite components, or only zeros."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine & F.exists(vector, lambda x: x.cast("double") != 0), F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)))


def cosine(a: str, b: str) -> Column:
    """Cosine in doubles, summed in the order of the components."""
    add = lambda s, x: s + x
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), add)
    norm = lambda v: F.sqrt(F.aggregate(F.transform(v, lambda x: x * x), F.lit(0.0), add))
    return dot / (norm(a) * norm(b))


def code(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and misses of the rows, taken to length 1."""
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    miss = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return codes, scale, miss


def _code_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, dims = batch.column("vector"), batch.column("dim").to_numpy()
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(dims)
        for dim in np.unique(dims):
            rows = np.flatnonzero(dims == dim)
            for at in range(0, len(rows), TILE_ROWS):
                some = rows[at:at + TILE_ROWS]
                codes, scale, miss = code(flat[(ends[some] - dim)[:, None] + np.arange(dim)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cls").take(pa.array(some)), batch.column("dim").take(pa.array(some)), batch.column("asks").take(pa.array(some)),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale), pa.array(miss)], ["cls", "dim", "asks", "code", "scale", "miss"])


_CODES = "cls long, dim int, asks boolean, code binary, scale double, miss double"
_PAIRS = "asking long, cls long, low double, high double"


def _unpacked(table: pa.Table):
    codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.int8).reshape(table.num_rows, -1)
    return table["cls"].to_numpy(), codes, table["scale"].to_numpy(), table["miss"].to_numpy()


def tile_pairs(asking, classes, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(asking, class, lower and upper bound of the cosine) of all pairs of two blocks that can be among an asking
    class's k nearest of this block, itself aside."""
    q_cls, q_codes, q_scale, q_miss = asking
    v_cls, v_codes, v_scale, v_miss = classes
    dim = max(1, q_codes.shape[1])
    kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64  # in which sums of int8 products are exact
    for a in range(0, len(q_cls), TILE_ROWS):
        rows = slice(a, a + TILE_ROWS)
        left, heaps = q_codes[rows].astype(kind), np.full((len(q_cls[rows]), k), -np.inf)
        kept = []
        for b in range(0, len(v_cls), TILE_ROWS):
            cols = slice(b, b + TILE_ROWS)
            product = (left @ v_codes[cols].astype(kind).T).astype(float)
            about = product * q_scale[rows][:, None] * v_scale[cols][None, :]
            off = q_miss[rows][:, None] + (1 + q_miss[rows][:, None]) * v_miss[cols][None, :] + SLACK
            low = np.where(q_cls[rows][:, None] == v_cls[cols][None, :], -np.inf, about - off)
            both = np.concatenate([heaps, low], 1)
            heaps = np.partition(both, both.shape[1] - k, 1)[:, -k:]
            i, j = np.nonzero((about + off >= heaps.min(1)[:, None]) & (low > -np.inf))
            kept.append((i, j + b, low[i, j], (about + off)[i, j]))
        i, j, low, high = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.zeros(0, int),) * 4
        use = high >= heaps.min(1)[i] if len(i) else np.zeros(0, bool)
        yield q_cls[rows][i[use]], v_cls[j[use]], low[use], high[use]


def _tiles(k: int):
    def run(classes: pa.Table, asking: pa.Table) -> pa.Table:
        found = []
        if classes.num_rows and asking.num_rows:
            found = list(tile_pairs(_unpacked(asking), _unpacked(classes), k))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)] * 2
        return pa.table([pa.array(c) for c in columns], ["asking", "cls", "low", "high"])

    return run


def nearest(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): for each row that ``queries`` selects the k other rows of the greatest cosine, ties to
    the smaller id (null ids last); all of them if they are fewer.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part; vectors only meet those of as many
    components; squares of components and their sums are to be finite and above zero in doubles. Rows that repeat an id or
    a vector are rows of their own, and each other's candidates. Other columns are not read.
    """
    table = written(rows.select(F.col(f"`{id_col}`").alias("id"), usable(F.col(f"`{vector_col}`")).alias("vector"),
                                F.coalesce(queries, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("key"))
                    .where(F.col("vector").isNotNull()), "vectors")
    order = [F.col("id").asc_nulls_last(), F.col("key")]
    first = table.withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy(*order))).where(F.col("nth") <= k + 1)
    asked = table.where("asks").groupBy("vector").agg(F.lit(True).alias("asks"))
    classes = first.groupBy("vector").agg(F.collect_list(F.struct("id", "key")).alias("members"))  # k + 1 at most
    classes = written(classes.join(asked, "vector", "left").select(
        F.monotonically_increasing_id().alias("cls"), "vector", F.size("vector").alias("dim"), "members", F.coalesce("asks", F.lit(False)).alias("asks")), "classes")
    codes = written(classes.select("cls", "dim", "asks", "vector").mapInArrow(_code_batches, _CODES), "codes")
    n, n_asking = codes.agg(F.count("*"), F.count_if("asks")).first()
    blocks, sides = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n_asking // ASKING_ROWS))
    dealt = codes.withColumn("block", F.pmod(F.xxhash64("cls"), F.lit(blocks))).withColumn(
        "side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1)).cast("array<long>")))
    asking = codes.where("asks").withColumn("side", F.pmod(F.xxhash64("cls"), F.lit(sides))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    pairs = dealt.groupBy("dim", "block", "side").cogroup(asking.groupBy("dim", "block", "side")).applyInArrow(_tiles(k), _PAIRS)
    pairs = written(pairs, "pairs")
    least = pairs.withColumn("nth", F.row_number().over(Window.partitionBy("asking").orderBy(F.desc("low")))).where(F.col("nth") == k)
    pairs = pairs.join(least.select("asking", F.col("low").alias("least")), "asking", "left").where(F.col("least").isNull() | (F.col("high") >= F.col("least")))
    own = classes.where(F.col("asks") & (F.size("members") > 1)).select(F.col("cls").alias("asking"), "cls")
    pairs = pairs.select("asking", "cls").unionByName(own)
    scored = pairs.join(classes.select(F.col("cls").alias("asking"), F.col("vector").alias("from")), "asking").join(
        classes.select("cls", F.col("vector").alias("to"), "members"), "cls")
    scored = scored.select("asking", cosine("from", "to").alias("score"), F.explode("members").alias("m")).select("asking", "score", "m.*")
    best = Window.partitionBy("asking").orderBy(F.desc("score"), *order)
    lists = scored.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)  # one of them may be the query itself
    lists = lists.groupBy("asking").agg(F.collect_list(F.struct("score", "id", "key")).alias("near"))
    asks = table.where("asks").select(F.col("id").alias("query_id"), F.col("key").alias("query_key"), "vector")
    asks = asks.join(classes.where("asks").select("vector", F.col("cls").alias("asking")), "vector").drop("vector")
    found = asks.join(lists, "asking").select("query_id", "query_key", F.explode("near").alias("n")).select("query_id", "query_key", "n.*")
    found = found.where(F.col("key") != F.col("query_key"))
    rank = F.row_number().over(Window.partitionBy("query_key").orderBy(F.desc("score"), *order))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
