"""Whole-table and per-group scaling.

A whole-table window (``Window.partitionBy()``) would plan ``Exchange SinglePartition``;
here the statistics are a 1-row aggregate broadcast back instead, and per-group statistics
are key-joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions.columns import agg_mean, agg_sd, agg_sum, col, safe_div
from strataframe.operators.attach import join_by
from strataframe.operators.ranks import median_mad_long


def zscore(df: DataFrame, c: str, by: Sequence[str] = (), out: str | None = None,
           where: Column | None = None, skip_nulls: bool = False) -> DataFrame:
    """(x − mean)/sd; with ``where``, statistics use and scaling applies to those rows only,
    the others keep their value (W4, W8). A NULL among the values makes the group's scale NULL,
    unless ``skip_nulls``."""
    out = out or f"z_{c}"
    src = df.filter(where) if where is not None else df
    stats = src.groupBy(*by).agg(agg_mean(c, skip_nulls).alias("_mu"), agg_sd(c, skip_nulls).alias("_sd"))
    z = safe_div(F.col(c) - F.col("_mu"), F.col("_sd"))
    joined = join_by(df, stats, by)
    if where is not None:
        z = F.when(where, z).otherwise(F.col(c).cast("double"))
    return joined.withColumn(out, z).drop("_mu", "_sd")


def robust_scale(df: DataFrame, cols_: Sequence[str], by: Sequence[str] = (),
                 skip_nulls: bool = False) -> DataFrame:
    """(x − median(x)) / mad(x) for several columns at once.

    All medians and MADs come from one distributed quantile job over the stacked columns;
    the result has one row per group with two values per column.
    """
    stats = median_mad_long(df, cols_, by, skip_nulls)
    wide = stats.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("median"))).alias(f"_med_{c}") for c in cols_],
        *[F.max(F.when(F.col("column") == c, F.col("mad"))).alias(f"_mad_{c}") for c in cols_])
    joined = join_by(df, wide, by)
    for c in cols_:
        joined = joined.withColumn(c, safe_div(F.col(c) - F.col(f"_med_{c}"), F.col(f"_mad_{c}")))
    return joined.drop(*[f"_med_{c}" for c in cols_], *[f"_mad_{c}" for c in cols_])


def share_of_total(df: DataFrame, expr, out: str, by: Sequence[str] = (), skip_nulls: bool = False) -> DataFrame:
    """expr / sum(expr) over the table or group."""
    e = col(expr)
    tot = df.groupBy(*by).agg(agg_sum(e, skip_nulls).alias("_tot"))
    return join_by(df, tot, by).withColumn(out, safe_div(e, F.col("_tot"))).drop("_tot")
