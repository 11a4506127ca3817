"""The sweep that finds undominated rows inside a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def group_codes(batch: pa.RecordBatch, by: Sequence[str]) -> np.ndarray:
    """A number for each row's group; NULL keys are groups."""
    code = np.zeros(batch.num_rows, np.int64)
    for c in by:
        own = batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
        code = np.unique(code * (batch.num_rows + 1) + own, return_inverse=True)[1]
    return code


def _ranked(column: pa.Array) -> np.ndarray:
    """Whole numbers in the order of the values, equal for equal values."""
    if pa.types.is_floating(column.type):
        column = pc.if_else(pc.equal(column, 0.0), pa.scalar(0.0, column.type), column)  # -0.0 and 0.0 are one value
    return pc.rank(column, sort_keys="ascending", tiebreaker="dense").to_numpy().astype(np.int64)


def undominated(by: Sequence[str], cost: str, value: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keep the rows of a batch that no row of their group in the batch beats. Costs and values are not NULL."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            group, costs, values = group_codes(batch, by), _ranked(batch.column(cost)), _ranked(batch.column(value))
            order = np.lexsort((-values, costs, group))
            g, c, height = group[order], costs[order], group[order] * (n + 1) + values[order]  # a later group starts higher
            start = np.ones(n, bool)
            start[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
            which, first = np.cumsum(start) - 1, np.flatnonzero(start)  # rows of one group and cost: the best comes first
            before = np.append(-1, np.maximum.accumulate(height))[first]
            keep = (height[first] > before)[which] & (height == height[first][which])
            yield batch.take(pa.array(np.sort(order[keep])))

    return run
