"""Attach aggregates to rows: a 1-row table to every row, or per-group rows by NULL-safe keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _present() -> Column:
    """1 on every row, but not a constant that the optimizer folds out of a join key."""
    return F.when(F.spark_partition_id() >= 0, 1)


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a 1-row table (an aggregate, a fit) to every row of ``df``.

    Nothing runs while the plan is built: the row is computed when the query is, and joined on a
    column that is 1 everywhere, as a broadcast of one row. An empty ``one_row`` gives NULLs; more
    than one row is an error at run time.
    """
    names = one_row.columns
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in names]))
    kind = one_row.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("r")).schema["r"].dataType
    single = one_row.agg(F.when(F.count("*") <= 1, row).otherwise(
        F.raise_error(F.lit("attach_row needs a table of at most one row")).cast(kind)).alias("_r"))
    single = F.broadcast(single.withColumn("_one", _present()))  # one row by its aggregate
    joined = df.withColumn("_here", _present()).join(single, F.col("_here") == F.col("_one"))
    return joined.select(*[df_col for df_col in (F.col(f"`{c}`") for c in df.columns)],
                         *[F.col("_r").getField(c).alias(c) for c in names])


def join_by(df: DataFrame, other: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``by`` in which NULL keys match each other (R keeps NA as a group).

    The key columns come from ``df``; without ``by``, ``other`` is a 1-row table.
    """
    by = list(by)
    if not by:
        return attach_row(df, other)
    right = other.select(*[F.col(f"`{c}`").alias(f"_by_{i}") for i, c in enumerate(by)],
                         *[F.col(f"`{c}`") for c in other.columns if c not in by])
    cond = F.lit(True)
    for i, c in enumerate(by):
        cond = cond & df[f"`{c}`"].eqNullSafe(right[f"_by_{i}"])
    return df.join(right, cond, how).drop(*[f"_by_{i}" for i in range(len(by))])


def count_up(df: DataFrame, lo: str, hi: str, out: str, step: int = 1024) -> DataFrame:
    """One row of ``df`` for each whole number lo..hi, in ``out``.

    Numbers are made in three steps of ``step``, spread over tasks in between, so no cell or task
    holds a long range.
    """
    first, last = F.col(lo).cast("long"), F.col(hi).cast("long")
    wide = df.filter(first <= last)
    for size in (step * step, step, 1):
        floor = F.floor(first / size).cast("long") * size if size > 1 else first
        start = floor if size == step * step else F.greatest(floor, F.col("_c"))
        stop = last if size == step * step else F.least(last, F.col("_c") + (size * step - 1))
        wide = wide.withColumn("_c", F.explode(F.sequence(start, stop, F.lit(size).cast("long"))))
        if size == step * step:
            wide = wide.repartition(F.col("_c"))
    return wide.withColumn(out, F.col("_c")).drop("_c")
