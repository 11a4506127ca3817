"""Equi-joins in which a few keys hold much of a table: these keys are found and spread, the rest joins as usual."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.operators.attach import attach_row, join_by

#: A key is heavy if it has more than one in so many rows; so there are fewer heavy keys than that.
HEAVY_SHARE = 1000


def heavy_keys(df: DataFrame, on: Sequence[str], share: int = HEAVY_SHARE) -> DataFrame:
    """1-row table with ``_heavy``: hashes of the keys with more than one in ``share`` rows (fewer than ``share`` keys).

    They are counted, not sketched: both sides of a join must find the same ones, whenever they are computed.
    """
    counts = df.groupBy(F.xxhash64(*[F.col(f"`{c}`") for c in on]).alias("h")).agg(F.count("*").alias("c"))
    total = counts.agg(F.sum("c").alias("_all"))
    found = attach_row(counts, total).filter(F.col("c") * share > F.col("_all"))
    return found.agg(F.array_sort(F.collect_list("h")).alias("_heavy"))


def join_heavy(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", share: int = HEAVY_SHARE,
               parts: int | None = None) -> DataFrame:
    """``join_by`` (NULL keys match) in which the rows of ``left`` with a heavy key go to ``parts`` tasks, each with a copy of
    the rows of ``right`` with that key. ``how`` is inner, left, left_semi or left_anti.

    ``parts`` defaults to the number of shuffle partitions. Rows of ``left`` go by a hash of the whole row and of the task
    that reads them, so equal rows are spread too. ``right`` should have few rows of a heavy key: each is copied ``parts`` times.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("join_heavy joins inner, left, left_semi or left_anti")
    parts = parts or max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    heavy = heavy_keys(left, on, share)
    is_heavy = F.array_contains("_heavy", F.xxhash64(*[F.col(f"`{c}`") for c in on]))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns], F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    few = F.array(F.lit(0))
    every = F.sequence(F.lit(0), F.lit(parts - 1))
    a = attach_row(left.withColumn("_spread", spread), heavy).withColumn("_salt", F.when(is_heavy, F.col("_spread")).otherwise(0)).drop("_heavy", "_spread")
    b = attach_row(right, heavy).withColumn("_salt", F.explode(F.when(is_heavy, every).otherwise(few))).drop("_heavy")
    return join_by(a, b, [*on, "_salt"], how).drop("_salt")
