"""Quantile sketches as columns: made per group, kept, merged over coarser groups, asked later (A14 at scale).

The sketches are the KLL sketches that Spark aggregates: their size is bounded whatever the rows, and the rank of an answer
differs from the wanted one by ``rank_error`` at most, with a confidence of 99 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches.
K = 800


def rank_error(k: int = K) -> float:
    """Normalised rank error of one answer at 99 % confidence: the published fit 2.296 / k ** 0.9021."""
    return 2.296 / k ** 0.9021


def quantile_sketches(df: DataFrame, c: str, by: Sequence[str] = (), out: str = "sketch", k: int = K) -> DataFrame:
    """(by..., n, sketch) of the non-NULL values of ``c``, as doubles."""
    return df.groupBy(*by).agg(F.count(c).alias("n"), F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(out))


def merged_sketches(sketches: DataFrame, by: Sequence[str] = (), out: str = "sketch", k: int = K) -> DataFrame:
    """The sketches of coarser groups from those of finer ones; no row is read again."""
    return sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double(F.col(out), F.lit(k)).alias(out))


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float], by: Sequence[str] = (), sketch: str = "sketch") -> DataFrame:
    """(by..., prob, value): values of the data whose ranks are near the wanted ones; NULL for groups without values."""
    answer = lambda p: F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(p))))
    asked = F.array(*[F.struct(F.lit(float(p)).alias("prob"), answer(p).alias("value")) for p in probs])
    return sketches.select(*by, F.explode(asked).alias("_a")).select(*by, "_a.*")
