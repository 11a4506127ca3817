"""Sources: named parquet tables, literal tables and generated grids/panels."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.columns import normal_pair

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def table(spark: SparkSession, rows, schema) -> DataFrame:
    """Literal table from rows and a DDL schema string.

    Spark does not know the size of such a table and would deal out what joins it by key, a task for each of its few
    keys. It is written in the program, so it is marked to go to every task instead.
    """
    return F.broadcast(spark.createDataFrame(rows, schema))


def grid(one_row: DataFrame, n_col: str, lo: float, hi: float, out: str = "grid") -> DataFrame:
    """``seq(lo, hi, len = n)``, with n from a 1-row table whose other columns each point keeps (S3).

    Points are counted up in steps and spread over tasks; no row of the data is touched.
    """
    from strataframe.operators.attach import count_up

    n = F.col(n_col)
    step = F.when(n > 1, (F.lit(hi) - F.lit(lo)) / (n - 1)).otherwise(F.lit(0.0))
    points = count_up(one_row.withColumn("_from", F.lit(0)).withColumn("_to", n - 1), "_from", "_to", "_i")
    return points.withColumn(out, F.lit(lo) + F.col("_i").cast("double") * step).drop("_from", "_to", "_i")


def normal_panel(base: DataFrame, group_col: str, n: int, seed: int) -> DataFrame:
    """Grouped i.i.d. normal sample: n (x, y) draws per row of ``base``.

    Each group's draws are made by the task that holds the group's row (a bounded explode,
    never a cross join); (x, y) are the two Box–Muller halves of one md5 of (seed, group, i). The groups are dealt out
    by key before the draws are made: a draw costs far more than its group's key, and what is aggregated by group
    afterwards needs no other exchange.
    """
    parts = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = base.select(F.col(group_col).alias("group")).repartition(parts, "group").select(
        "group", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    x, y = normal_pair(seed, "group", "i")
    return out.select("group", "i", x.alias("x"), y.alias("y"))


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, folders: list[str] = ()) -> DataFrame:
    """``df`` as table ``name``, stored below ``path`` in ``buckets`` files per task by a hash of ``keys`` and sorted by them, in a
    folder for each value of ``folders``; read back.

    Two tables of as many buckets by the same keys join without an exchange, whatever their size; conditions on
    ``folders`` choose folders before any file is opened. Rows are dealt out by key first, so each bucket of a folder is one
    file. A key that holds much of a table makes one large file: join such keys with ``heavy.join_heavy``.
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.mode("errorifexists").option("path", path).format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    (writer.partitionBy(*folders) if folders else writer).saveAsTable(name)
    return spark.table(name)
