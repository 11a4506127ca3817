"""Long ↔ wide reshaping (R family)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions.columns import text_or_na


def spread(df: DataFrame, ids: Sequence[str], key: str, value: str,
           values: Sequence) -> DataFrame:
    """Long → wide with one column per key value.

    The value list is an argument (a fixed schema, no extra job to find it). A duplicate
    (ids, key) raises, as ``spread`` does; a missing cell is NULL.
    """
    ids = list(ids)
    checked = (df.groupBy(*ids, key)
               .agg(F.when(F.count("*") > 1,
                           F.raise_error(F.lit(f"spread: duplicate key in column {key}")))
                    .otherwise(F.first(value)).alias(value)))
    out = checked.groupBy(*ids).pivot(key, list(values)).agg(F.first(value))
    return out.select(*ids, *[F.col(f"`{v}`").alias(str(v)) for v in values])


def gather(df: DataFrame, ids: Sequence[str], cols_: Sequence[str], name: str,
           value: str) -> DataFrame:
    """Wide → long over ``cols_`` (R3, R4); NULL values are kept."""
    return df.unpivot(list(ids), list(cols_), name, value)


def unite(df: DataFrame, new: str, cols_: Sequence[str], sep: str = "_",
          remove: bool = True) -> DataFrame:
    """Join columns into one text key; NULL is written as ``NA``."""
    out = df.withColumn(new, F.concat_ws(sep, *[text_or_na(c) for c in cols_]))
    return out.drop(*cols_) if remove else out
