"""Aggregates (A family): strict summaries, correlation matrices, weighted means, shares,
strata, conditional means, cross-tabulation and sequential summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions.columns import col, pair_corr, rnd, safe_div, strict


def corr_matrix(df: DataFrame, cols_: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """All pairwise correlations in one aggregate pass, returned long (A4)."""
    pairs = [(a, b) for i, a in enumerate(cols_) for b in cols_[i + 1:]]
    wide = df.groupBy(*by).agg(*[strict(pair_corr(a, b), a, b).alias(f"{a}__{b}")
                                 for a, b in pairs])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"{a}__{b}").alias("r"))
        for a, b in pairs])).alias("_p")
    return wide.select(*by, stacked).select(*by, "_p.*")


def weighted_mean(x, w, skip_nulls: bool = False) -> Column:
    """sum(x·w) / sum(w) (A11): NULL with a NULL among values or weights, unless ``skip_nulls``;
    then a row counts if it has both."""
    x, w = col(x), col(w)
    weight = F.when(x.isNotNull(), w)
    mean = safe_div(F.sum(x * w), F.sum(weight))
    return mean if skip_nulls else strict(mean, x, w)


def share(pred: Column, w, percent: bool = True, skip_nulls: bool = False) -> Column:
    """Weighted share of rows satisfying ``pred`` (A12); NULLs as in ``weighted_mean``."""
    s = weighted_mean(pred.cast("int"), w, skip_nulls)
    return s * 100.0 if percent else s


def proportion(pred: Column) -> Column:
    """Share of rows where ``pred`` holds; NULL predicates count as NULL (A10)."""
    return F.avg(pred.cast("int"))


def yes_no(percent, n) -> tuple[Column, Column]:
    """Counts rebuilt from a percentage: yes = round(p/100·n), no = n − yes."""
    yes = rnd(col(percent) / 100.0 * col(n), 0)
    return yes, col(n) - yes


def summarize_at(df: DataFrame, by: Sequence[str], cols_: Sequence[str],
                 fn: Callable[[Column], Column]) -> DataFrame:
    """The same aggregate over a list of columns."""
    return df.groupBy(*by).agg(*[fn(F.col(c)).alias(c) for c in cols_])


def strata(df: DataFrame, expr: Column, name: str, digits: int = 0,
           lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Add a stratum key ``bround(expr, digits)`` and keep strata in [lo, hi]."""
    out = df.withColumn(name, rnd(expr, digits))
    if lo is not None:
        out = out.filter(F.col(name) >= lo)
    if hi is not None:
        out = out.filter(F.col(name) <= hi)
    return out


def conditional_mean(df: DataFrame, x: str, y: str, digits: int = 0,
                     name: str | None = None) -> DataFrame:
    """Mean of y per rounded x."""
    name = name or f"{x}_strata"
    return (df.groupBy(rnd(x, digits).alias(name))
            .agg(strict(F.avg(y), y).alias(f"{y}_conditional_avg"),
                 F.count("*").alias("n")))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts of (row, column) with one output column per value; missing cells are 0."""
    return df.groupBy(row).pivot(column, list(values)).count().fillna(0)


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long form of ``crosstab`` for a high-cardinality column."""
    return df.groupBy(row, column).agg(F.count("*").alias("n"))


def summarize_seq(df: DataFrame, by: Sequence[str], raw: dict[str, Column],
                  derived: Sequence[tuple[str, Column]], keep_raw: bool = False) -> DataFrame:
    """Aggregates that use earlier aggregates of the same call.

    ``raw`` aggregates are computed once under their (private) names; ``derived`` steps are
    applied in order on the aggregated row, so a later step sees earlier results. Raw aggregates
    whose names begin with _ are dropped at the end, unless ``keep_raw``.
    """
    out = df.groupBy(*by).agg(*[e.alias(n) for n, e in raw.items()])
    for name, e in derived:
        out = out.withColumn(name, e)
    return out if keep_raw else out.drop(*[n for n in raw if n.startswith("_")])
