"""The statistics behind the scripts' plots, as tables (V1–V9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.functions.columns import norm_ppf
from strataframe.operators.ols import ols
from strataframe.operators.attach import count_up, join_by
from strataframe.operators.ranks import positions, quantiles


def histogram(df: DataFrame, c: str, width: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts in bins of ``width`` centred on multiples of width, closed on the right;
    empty bins between the first and last one are listed with count 0 (V1)."""
    by = list(by)
    k = F.ceil(F.col(c) / width - 0.5).cast("long")
    counts = df.filter(F.col(c).isNotNull()).groupBy(*by, k.alias("bin")).agg(
        F.count("*").alias("count"))
    span = counts.groupBy(*by).agg(F.min("bin").alias("_lo"), F.max("bin").alias("_hi"))
    every = count_up(span, "_lo", "_hi", "bin").select(*by, "bin")
    out = join_by(every, counts, [*by, "bin"], "left").fillna(0, ["count"])
    return out.select(*by, "bin", (F.col("bin") * width).alias("x"),
                      ((F.col("bin") - 0.5) * width).alias("xmin"),
                      ((F.col("bin") + 0.5) * width).alias("xmax"), "count")


def boxplot(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """Box-plot numbers per group: quartiles (type 7), whiskers at the most extreme rows
    within 1.5·IQR of the box, and the number of outliers (V2)."""
    by = list(by)
    q = quantiles(df, x, [0.25, 0.5, 0.75], by, ["q1", "median", "q3"], skip_nulls=True)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    rows = join_by(df.select(*by, x).filter(F.col(x).isNotNull()), q, by)
    inside = (F.col(x) >= lo_f) & (F.col(x) <= hi_f)
    w = rows.groupBy(*by).agg(F.min(F.when(inside, F.col(x))).alias("ymin"),
                              F.max(F.when(inside, F.col(x))).alias("ymax"),
                              F.count_if(~inside).alias("n_outliers"),
                              F.count("*").alias("n"))
    return join_by(q, w, by)


def box_outliers(df: DataFrame, x: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows drawn as points by a box plot: outside [q1 − 1.5·IQR, q3 + 1.5·IQR] (V2)."""
    by = list(by)
    q = quantiles(df, x, [0.25, 0.75], by, ["_q1", "_q3"], skip_nulls=True)
    iqr = F.col("_q3") - F.col("_q1")
    rows = join_by(df.filter(F.col(x).isNotNull()), q, by)
    return rows.filter((F.col(x) < F.col("_q1") - 1.5 * iqr)
                       | (F.col(x) > F.col("_q3") + 1.5 * iqr)).drop("_q1", "_q3")


def qq_normal(df: DataFrame, c: str, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Sorted sample against normal quantiles of ppoints(n) per group (V3)."""
    by = list(by)
    d = df.filter(F.col(c).isNotNull()).select(*by, key, c)
    pos = positions(d, by, [c, key], out="_pos")
    n = d.groupBy(*by).agg(F.count("*").alias("_n"))
    a = F.when(F.col("_n") <= 10, F.lit(3.0 / 8.0)).otherwise(F.lit(0.5))
    p = (F.col("_pos") + 1 - a) / (F.col("_n") + 1 - 2 * a)
    return (join_by(pos, n, by)
            .select(*by, key, F.col(c).alias("sample"), norm_ppf(p).alias("theoretical")))


def smooth_lm(df: DataFrame, x: str, y: str, by: Sequence[str] = (), points: int = 80,
              level: float = 0.95) -> DataFrame:
    """Fitted line with confidence band on ``points`` x values per group (V4)."""
    by = list(by)
    fit = ols(df, y, [x], by, conf_level=level)
    seen = F.when(F.col(y).isNotNull(), F.col(x))  # rows without a response are no part of the fit, nor of its range
    span = df.groupBy(*by).agg(F.min(seen).alias("_lo"), F.max(seen).alias("_hi"))
    grid = span.select(*by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
                       .alias("_i"))
    grid = grid.withColumn(x, F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_i")
                           / float(points - 1)).drop("_lo", "_hi")
    pred = fit.predict(grid, out="fitted", se=True)
    tq = fit.inference_df.select(*by, F.col("t_crit"))
    pred = join_by(pred, tq, by)
    return pred.select(*by, "_i", x, "fitted", "se_fit",
                       (F.col("fitted") - F.col("t_crit") * F.col("se_fit")).alias("ymin"),
                       (F.col("fitted") + F.col("t_crit") * F.col("se_fit")).alias("ymax"))


def stack(df: DataFrame, by: Sequence[str], x: str, fill: str, value: str) -> DataFrame:
    """Stacked bar segments per (facet, x): running sum over fill levels.

    The window is partitioned by the bar (facet, x), whose size is the number of fill
    levels.
    """
    w = (Window.partitionBy(*by, x).orderBy(F.col(fill).asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn("ymax", F.sum(value).over(w))
            .withColumn("ymin", F.col("ymax") - F.col(value)))
