"""Row/column verbs: sequential mutate, column selection forms, group filters, joins,
top-n with ties, first row per group, arg-max forms (P, J, O, T families)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.operators.attach import attach_row, join_by


def mutate(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Derive columns in order; a later step sees earlier (possibly overwritten) columns.

    Chained ``withColumn`` gives exactly that; Catalyst collapses the projections into one
    codegen stage.
    """
    for name, expr in steps:
        df = df.withColumn(name, expr)
    return df


def cols(df: DataFrame, names: Sequence[str] | None = None, first: str | None = None,
         last: str | None = None, except_: Sequence[str] = (),
         positions: Sequence[int] = ()) -> list[str]:
    """Column names chosen by list, by range ``first:last``, by exclusion or by position."""
    all_cols = df.columns
    chosen = list(names) if names else list(all_cols)
    if first or last:
        i = all_cols.index(first) if first else 0
        j = all_cols.index(last) if last else len(all_cols) - 1
        chosen = all_cols[i:j + 1]
    if positions:
        chosen = [all_cols[p] for p in positions]
    return [c for c in chosen if c not in set(except_)]


def filter_group(df: DataFrame, by: Sequence[str], aggs: Sequence[Column],
                 predicate: Column) -> DataFrame:
    """Keep the rows of groups whose aggregates satisfy ``predicate``.

    The per-group aggregate is partial + final (no group is gathered in one task) and the
    qualifying keys are semi-joined back; a NULL key is a group like any other.
    """
    keys = df.groupBy(*by).agg(*aggs).filter(predicate).select(*by)
    return join_by(df, keys, by, "left_semi")


def exclude_row(df: DataFrame, key: str, k) -> DataFrame:
    """All rows except the one whose key equals k; rows without a key stay."""
    return df.filter(~F.col(key).eqNullSafe(F.lit(k)))


def top_n(df: DataFrame, n: int, c: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``c`` ranks in the top n (ties kept, NULLs dropped) (O3).

    The nth value is found first, of n rows from each task; all rows that reach it are kept, so
    ties stay where they are, however many there are.
    """
    by = list(by)
    valued = df.filter(F.col(c).isNotNull())
    if by:
        order = Window.partitionBy(*by).orderBy(F.col(c).desc())
        best = valued.select(*by, c).withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n)
    else:
        best = valued.select(c).orderBy(F.col(c).desc()).limit(n)
    least = best.groupBy(*by).agg(F.min(c).alias("_least"))
    return join_by(valued, least, by).filter(F.col(c) >= F.col("_least")).drop("_least")


def first_per_group(df: DataFrame, by: Sequence[str], value: str, tiebreak: str,
                    descending: bool = True) -> DataFrame:
    """The row with the largest (or smallest) ``value`` per group, ties to the smallest
    ``tiebreak`` (W1). NULL values come last, so every group keeps a row; any type that can be
    ordered will do. Each task passes on one row of a group."""
    first = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    order = Window.partitionBy(*by).orderBy(first, F.col(tiebreak).asc_nulls_last())
    return df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == 1).drop("_rn")


def label_extreme(df: DataFrame, by: Sequence[str], c: str, out: str,
                  when_min: str, otherwise: str) -> DataFrame:
    """Label rows holding the group minimum of ``c`` (W2), via aggregate + join."""
    mins = df.groupBy(*by).agg(F.min(c).alias("_min"))
    return (join_by(df, mins, by)
            .withColumn(out, F.when(F.col(c) == F.col("_min"), when_min).otherwise(otherwise))
            .drop("_min"))


def first_row(df: DataFrame, value: str, key: str) -> DataFrame:
    """The row with the largest ``value``, ties to the smallest ``key``; any type that can be ordered. Each task
    passes on one row."""
    return df.filter(F.col(value).isNotNull()).orderBy(F.col(value).desc(), F.col(key).asc_nulls_last()).limit(1)


def argmax_row(df: DataFrame, key: str, value: str) -> DataFrame:
    """1-row table: the key of the row with the largest value, ties to the smallest key (O5); NULL if
    there is no value."""
    return first_row(df.select(*dict.fromkeys([key, value])), value, key).agg(F.first(key).alias(key))


def argmax_cols(cols_: Sequence[str], names: Sequence[str] | None = None) -> Column:
    """Name of the column holding the row maximum; first one on ties (``which.max``)."""
    names = list(names or cols_)
    arr = F.array(*[F.col(c) for c in cols_])
    labels = F.array(*[F.lit(n) for n in names])
    return F.element_at(labels, F.array_position(arr, F.array_max(arr)).cast("int"))


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a 1-row table's columns to every row."""
    return attach_row(df, one_row)


def join_suffix(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
                suffixes: tuple[str, str] = ("_x", "_y"), null_matches: bool = True) -> DataFrame:
    """Join where same-named non-key columns get suffixes.

    As in R, NULL keys match NULL keys; ``null_matches=False`` is SQL's rule. The key columns of
    the result hold the key of whichever side has the row.
    """
    on = list(on)
    clash = (set(left.columns) & set(right.columns)) - set(on)
    l2 = left.select(*[F.col(c).alias(c + suffixes[0]) if c in clash else F.col(c)
                       for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + suffixes[1]) if c in clash else F.col(c)
                        for c in right.columns])
    if not null_matches:
        return l2.join(r2, on, how)
    if how in ("inner", "left"):
        joined = join_by(l2, r2, on, how)
    elif how == "right":
        joined = join_by(r2, l2, on, "left")
    else:
        raise ValueError("null_matches joins are inner, left or right")
    rest = [c for c in (*l2.columns, *r2.columns) if c not in on]
    return joined.select(*on, *rest)


def left_join(left: DataFrame, right: DataFrame, on: Sequence[str], null_matches: bool = True) -> DataFrame:
    return join_suffix(left, right, on, "left", null_matches=null_matches)


def right_join(left: DataFrame, right: DataFrame, on: Sequence[str], null_matches: bool = True) -> DataFrame:
    """All rows of ``right``; the left side's columns come first."""
    return join_suffix(left, right, on, "right", null_matches=null_matches)


def semi_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return join_by(left, right.select(*on), on, "left_semi")


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append rows with the same columns."""
    return a.unionByName(b)


def sort_desc(df: DataFrame, *cs: str) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cs])


def sort_asc(df: DataFrame, *cs: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cs])


def per_group(df: DataFrame, by: Sequence[str], fn: Callable, schema: str) -> DataFrame:
    """User function on each group returning a table (U1). The schema is required: an
    unnamed, non-table result is an error (U3). A whole group is one task: use the moment-based operators for
    fits, and ``fold.fold_groups`` where a group may be large."""
    if not schema:
        raise ValueError("per_group needs an output schema: a result must be a table")
    from strataframe.session import ship_package

    ship_package(df.sparkSession)
    return df.groupBy(*by).applyInPandas(fn, schema)


def skyline(df: DataFrame, by: Sequence[str], cost: str, value: str) -> DataFrame:
    """Rows no other row of the same group beats: none at most as costly and at least as
    good, and strictly better in one of the two (C5). Rows without a cost or value are dropped; equal rows stay.

    Each batch of each task keeps the rows that none of its own beats (sort and sweep); only these
    are shuffled and swept once more per group, by windows that can spill. So what a group's task gets
    are the survivors of the batches: few, unless cost and value rise together over the whole table.
    """
    from strataframe.operators.sweep import undominated
    from strataframe.session import ship_package

    ship_package(df.sparkSession)
    pool = df.filter(F.col(cost).isNotNull() & F.col(value).isNotNull())
    few = pool.mapInArrow(undominated(list(by), cost, value), pool.schema)
    group = list(by) or [F.lit(0)]
    best = Window.partitionBy(*group).orderBy(cost).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    kept = few.withColumn("_best", F.max(value).over(best)).withColumn("_least", F.min(cost).over(Window.partitionBy(*group, value)))
    return kept.filter((F.col(value) == F.col("_best")) & (F.col(cost) == F.col("_least"))).drop("_best", "_least")
