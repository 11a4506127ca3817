"""User functions on groups of any size: partial, merge, finish.

A task folds its rows into one state per group (an array of numbers), batch by batch; states of a group are merged
in two steps, first in as many shares as there are shuffle partitions, then together. So a group that
holds half of all rows is worked on by half of all tasks, and no task ever holds a group's rows.

Built on it: any additive function over a grid of parameters, and correlation matrices of many columns
from blocks of centred cross products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.operators.sweep import group_codes

#: Numbers of all states that a task keeps before it passes them on (64 MB).
KEPT_NUMBERS = 8_000_000
#: Most points of a grid: every task holds the grid. Rows and points of a block.
MOST_POINTS, BLOCK_ROWS, BLOCK_POINTS = 100_000, 4096, 256

Partial = Callable[[dict[str, np.ndarray]], np.ndarray]
Merge = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _partials(by: Sequence[str], cols: Sequence[str], partial: Partial, merge: Merge):
    def out(kept: dict) -> pa.RecordBatch:
        keys = pa.Table.from_batches([row for row, _ in kept.values()]).combine_chunks().to_batches()[0] if by else None
        states = [state for _, state in kept.values()]
        ends = np.cumsum([0, *map(len, states)]).astype(np.int32)
        column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(states)))
        return pa.RecordBatch.from_arrays([*(keys.columns if by else []), column], [*by, "_state"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = {}, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            code = group_codes(batch, by)
            order = np.argsort(code, kind="stable")
            values = {c: _numbers(batch.column(c))[order] for c in cols}
            first = np.flatnonzero(np.diff(code[order], prepend=-1))
            for a, b in zip(first, [*first[1:], batch.num_rows], strict=True):
                row = batch.select(list(by)).slice(int(order[a]), 1)
                key = tuple(map(repr, row.to_pylist()[0].values()))
                state = np.asarray(partial({c: v[a:b] for c, v in values.items()}), float)
                size += len(state) if key not in kept else 0
                kept[key] = (row, merge(kept[key][1], state) if key in kept else state)
            if size > KEPT_NUMBERS:
                yield out(kept)
                kept, size = {}, 0
        if kept:
            yield out(kept)

    return run


def _numbers(column: pa.Array) -> np.ndarray:
    """Numbers as doubles, NULL as NaN."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(float)


def _merged(table: pa.Table, merge: Merge) -> np.ndarray:
    states = [np.array(s, float) for s in table["_state"].to_pylist()]
    while len(states) > 1:  # pairwise, so that rounding errors stay small
        states = [merge(*states[i:i + 2]) if i + 1 < len(states) else states[i] for i in range(0, len(states), 2)]
    return states[0]


def fold_groups(df: DataFrame, by: Sequence[str], cols: Sequence[str], partial: Partial, merge: Merge,
                finish: Callable[[np.ndarray], list[tuple]], schema: str) -> DataFrame:
    """(by..., schema...): the rows that ``finish`` makes of each group's state.

    ``partial`` gets the columns ``cols`` of some of a group's rows, as doubles (NULL is NaN), and returns a state, an
    array of numbers whose size depends on the group alone; ``merge`` makes one of two states, in any order. A NULL key
    is a group; no rows give no rows. The result must be a table: ``schema`` says its columns.
    """
    from strataframe.session import ship_package

    if not schema:
        raise ValueError("fold_groups needs an output schema: a result must be a table")
    spark, by = df.sparkSession, list(by)
    ship_package(spark)
    keys = [T.StructField(c, df.schema[c].dataType) for c in by]
    numbers = T.StructField("_state", T.ArrayType(T.DoubleType()))
    result = T.StructType([*keys, *T.StructType.fromDDL(schema).fields])
    states = df.select(*by, *[c for c in cols if c not in by]).mapInArrow(_partials(by, cols, partial, merge), T.StructType([*keys, numbers]))

    def keyed(table: pa.Table, rows: list[tuple], fields: T.StructType) -> pa.Table:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(fields)
        lead = [pa.chunked_array([pa.concat_arrays([table[c].chunk(0).slice(0, 1)] * len(rows))]) if rows else pa.chunked_array([], arrow.field(c).type) for c in by]
        rest = [pa.array([r[i] for r in rows], arrow.field(len(by) + i).type) for i in range(len(fields) - len(by))]
        return pa.Table.from_arrays([*lead, *rest], schema=arrow)

    def share(table: pa.Table) -> pa.Table:
        return keyed(table, [(_merged(table, merge).tolist(),)], T.StructType([*keys, numbers]))

    def last(table: pa.Table) -> pa.Table:
        return keyed(table, [tuple(r) for r in finish(_merged(table, merge))], result)

    shares = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salted = states.withColumn("_share", F.pmod(F.spark_partition_id(), F.lit(shares)))
    merged = salted.groupBy(*by, "_share").applyInArrow(lambda t: share(t.drop_columns(["_share"])), T.StructType([*keys, numbers]))
    return merged.groupBy(*by).applyInArrow(last, result)


def grid_sums(df: DataFrame, cols: Sequence[str], grid: Sequence[float], loss: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray],
              by: Sequence[str] = (), out: str = "loss", point: str = "grid") -> DataFrame:
    """(by..., i, grid, loss): the sum over the rows of ``loss(columns, point)`` for every point of a grid.

    ``loss`` gets columns of n rows and points of shape (m, 1), and returns m x n numbers. Tasks add up blocks of
    points; a NULL among the values makes the sums NULL unless ``loss`` takes care of it.
    """
    points = np.asarray(grid, float)
    if len(points) > MOST_POINTS:
        raise ValueError(f"a grid of {len(points)} points does not fit into every task; the bound is {MOST_POINTS}")

    def partial(values: dict[str, np.ndarray]) -> np.ndarray:
        sums = np.zeros(len(points))
        for a in range(0, len(values[cols[0]]), BLOCK_ROWS):
            some = {c: v[a:a + BLOCK_ROWS] for c, v in values.items()}
            for b in range(0, len(points), BLOCK_POINTS):
                sums[b:b + BLOCK_POINTS] += loss(some, points[b:b + BLOCK_POINTS, None]).sum(1)
        return sums

    def finish(sums: np.ndarray) -> list[tuple]:
        return [(i, p, None if np.isnan(s) else s) for i, (p, s) in enumerate(zip(points.tolist(), sums.tolist(), strict=True))]

    return fold_groups(df, by, cols, partial, np.add, finish, f"i long, `{point}` double, `{out}` double")


def _cross(x: np.ndarray) -> np.ndarray:
    """State of k columns: rows, NULLs of each, means, upper triangle of the centred cross products."""
    holes = np.isnan(x).sum(0)
    x = np.nan_to_num(x)
    mean = x.mean(0)
    centred = x - mean
    return np.concatenate([[len(x)], holes, mean, (centred.T @ centred)[np.triu_indices(x.shape[1])]])


def _add_cross(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    n, m = a[0], b[0]
    shift = b[1 + k:1 + 2 * k] - a[1 + k:1 + 2 * k]
    mean = a[1 + k:1 + 2 * k] + shift * (m / (n + m))
    products = a[1 + 2 * k:] + b[1 + 2 * k:] + np.outer(shift, shift)[np.triu_indices(k)] * (n * m / (n + m))
    return np.concatenate([[n + m], a[1:1 + k] + b[1:1 + k], mean, products])


def corr_matrix_wide(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All pairwise correlations of many columns, returned long like ``corr_matrix`` (A4): one reading, one state of
    k * k / 2 numbers per task. A NULL in either column, or a constant one, makes the pair's result NULL."""
    cols, k = list(cols), len(cols)
    upper = np.triu_indices(k)

    def partial(values: dict[str, np.ndarray]) -> np.ndarray:
        return _cross(np.stack([values[c] for c in cols], 1))

    def finish(state: np.ndarray) -> list[tuple]:
        products = np.zeros((k, k))
        products[upper] = state[1 + 2 * k:]
        fine, spread = state[1:1 + k] == 0, np.diag(products)
        rows = []
        for i in range(k):
            for j in range(i + 1, k):
                ok = fine[i] and fine[j] and spread[i] > 0 and spread[j] > 0
                rows.append((cols[i], cols[j], float(products[i, j] / np.sqrt(spread[i] * spread[j])) if ok else None))
        return rows

    return fold_groups(df, by, cols, partial, lambda a, b: _add_cross(a, b, k), finish, "var1 string, var2 string, r double")
