"""Seeded sampling and the bootstrap.

Every draw is ``uniform(seed, draw id)`` (md5 based), so a retried task redraws the same
rows and DuckDB can replay the sample. Rows lie in ``BUCKETS`` buckets by a hash of their key. A draw goes to a
bucket with the bucket's share of the rows, which splits every replicate's draws multinomially over the
buckets, and then to one of the bucket's rows, numbered by key inside the bucket alone: no order of the
whole table is ever made. The table is read twice, once to count the buckets. Replicates
are a key column, so B replicates are one grouped aggregate instead of B jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.columns import safe_corr, uniform
from strataframe.operators.attach import attach_row
from strataframe.operators.ols import ols

#: Buckets of the rows of a sampled table, whatever its size, and the seed of their hash.
BUCKETS, BUCKET_SEED = 1024, "bucket"


def bucket_of(key: str) -> Column:
    return F.floor(uniform(BUCKET_SEED, key) * BUCKETS).cast("int")


def row_index(df: DataFrame, key: str, out: str = "_row") -> DataFrame:
    """Dense 0..M−1 index by (bucket, key), of a unique key (distributed, deterministic)."""
    work = attach_row(df.withColumn("_bucket", bucket_of(key)), _bucket_starts(df, key))
    return work.withColumn(out, F.col("_starts")[F.col("_bucket")] + _inside(key)).drop("_bucket", "_starts", "_m")


def _inside(key: str) -> Column:
    return F.row_number().over(Window.partitionBy("_bucket").orderBy(key)) - 1


def _bucket_starts(df: DataFrame, key: str) -> DataFrame:
    """1-row table: ``_starts``, the rows before each bucket (and, last, all rows), and ``_m``, all rows."""
    counts = df.groupBy(bucket_of(key).alias("b")).agg(F.count("*").alias("n"))
    one = counts.agg(F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("_m"))
    add = lambda s, b: F.concat(s, F.array(F.element_at(s, -1) + F.coalesce(F.col("n")[b], F.lit(0))))
    starts = F.aggregate(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), F.array(F.lit(0).cast("long")), add)
    return one.select(starts.alias("_starts"), "_m")


def _bucket_at(row: Column) -> Column:
    """The bucket of a row index: a binary search among the starts."""
    steps = F.array(*[F.lit(1 << k) for k in range(BUCKETS.bit_length() - 1, -1, -1)])
    further = lambda i, step: F.when(F.get("_starts", i + step) <= row, i + step).otherwise(i)
    return F.aggregate(steps, F.lit(0), further)


def _drawn(df: DataFrame, n_draws: int, seed: int, key: str, per_rep: int | None = None) -> DataFrame:
    """Drawn rows: draws name a bucket and a place in it, which the rows know by themselves."""
    d = df.sparkSession.range(n_draws).withColumnRenamed("id", "draw")
    if per_rep:
        d = d.withColumn("rep", F.floor(F.col("draw") / per_rep).cast("long"))
    d = attach_row(d, _bucket_starts(df, key)).withColumn("_row", F.floor(uniform(seed, "draw") * F.col("_m")).cast("long"))
    d = d.withColumn("_bucket", _bucket_at(F.col("_row"))).withColumn("_place", F.col("_row") - F.col("_starts")[F.col("_bucket")])
    rows = df.withColumn("_bucket", bucket_of(key)).withColumn("_place", _inside(key).cast("long"))
    return d.drop("_starts", "_m", "_row").join(rows, ["_bucket", "_place"]).drop("_bucket", "_place")


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """n rows drawn with replacement (X2); ``draw`` numbers the draws."""
    return _drawn(df, n, seed, key)


def bootstrap_sample(df: DataFrame, reps: int, n: int, seed: int, key: str) -> DataFrame:
    """reps × n draws with replacement, tagged with ``rep`` (X3 input)."""
    return _drawn(df, reps * n, seed, key, n)


def boot_corr(df: DataFrame, x: str, y: str, reps: int, n: int, seed: int,
              key: str) -> DataFrame:
    """Correlation of each bootstrap replicate."""
    s = bootstrap_sample(df, reps, n, seed, key)
    return s.groupBy("rep").agg(safe_corr(x, y).alias("r"))


def boot_ols(df: DataFrame, y: str, x: str, reps: int, n: int, seed: int,
             key: str) -> DataFrame:
    """OLS coefficients of each bootstrap replicate: (rep, beta_0, beta_1)."""
    s = bootstrap_sample(df, reps, n, seed, key)
    fit = ols(s, y, [x], by=["rep"])
    return fit.fit_df.select("rep", F.col("coef")[0].alias("beta_0"),
                             F.col("coef")[1].alias("beta_1"))


def boot_se(stats: DataFrame, cols_: Sequence[str]) -> DataFrame:
    """Mean and sd of replicate statistics."""
    aggs = []
    for c in cols_:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"se_{c}")]
    return stats.agg(*aggs)


def corr_se(r: Column, n: int) -> Column:
    """Normal-approximation slope sqrt((1 − r²)/(N − 2))."""
    return F.sqrt((F.lit(1.0) - r * r) / F.lit(float(n - 2)))


def sample_per_group(df: DataFrame, by: Sequence[str], seed: int, key: str, n: int = 1) -> DataFrame:
    """n rows per group without replacement, each row equally likely (X1): the rows with the
    smallest seeded uniforms. Each task passes on at most n rows of a group."""
    order = Window.partitionBy(*by).orderBy(uniform(seed, key), F.col(key))
    return df.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n).drop("_rn")


def normal_vector(base: DataFrame, key: str, seed: int, mean: float, sd: float,
                  out: str) -> DataFrame:
    """A normal draw per row of ``base`` with the given mean and sd."""
    from strataframe.functions.columns import normal

    return base.withColumn(out, normal(seed, key, F.lit(out), mean=mean, sd=sd))



__all__ = ["row_index", "sample_n", "bootstrap_sample", "boot_corr", "boot_ols", "boot_se",
           "corr_se", "sample_per_group", "normal_vector"]
