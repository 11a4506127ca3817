"""Inference helpers: rank correlation, chi-square 2×2, extreme-group fits and
year-to-year change (M21–M25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.functions import tails
from strataframe.operators.attach import attach_row
from strataframe.functions.columns import any_null, pair_corr, safe_corr
from strataframe.operators.ols import fit_moments, moments
from strataframe.operators.ranks import avg_ranks
from strataframe.operators.reshape import spread
from strataframe.operators.verbs import first_row

YATES_METHOD = "Pearson's Chi-squared test with Yates' continuity correction"


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Spearman correlation = Pearson correlation of average ranks."""
    d = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    r = avg_ranks(d.select(*by, x, y), [(x, by, "_rx"), (y, by, "_ry")])
    return r.groupBy(*by).agg(safe_corr("_rx", "_ry").alias("spearman"),
                              safe_corr(x, y).alias("pearson"))


def corr_excluding(df: DataFrame, x: str, y: str, key: str, k) -> DataFrame:
    """Correlation with and without the row whose key is k (M22), in one pass. Rows without a key stay; a
    NULL among the values that are left makes the result NULL."""
    keep = ~F.col(key).eqNullSafe(F.lit(k))
    kept = pair_corr(F.when(keep, F.col(x)), F.when(keep, F.col(y)))
    holes = F.count_if(keep & any_null(x, y))
    return df.agg(safe_corr(x, y).alias("r_all"), F.when(holes == 0, kept).alias("r_without"))


def chisq_margins(table: DataFrame, yes: str, no: str) -> DataFrame:
    """Continuity-corrected chi-square statistic of a 2×2 count table with rows
    (group, yes, no); one row out: statistic, parameter, method (M23).

    Margins are a 1-row aggregate broadcast back to the rows; the Yates term is
    min(0.5, |O − E|) over all cells, as R applies it. Tables of more or fewer rows are an
    error at run time.
    """
    cells = table.select(F.col(yes).cast("double").alias("_a"),
                         F.col(no).cast("double").alias("_b"))
    two = lambda c: F.when(F.count("*") == 2, c).otherwise(
        F.raise_error(F.lit("a 2x2 table has two rows")).cast("double"))
    tot = cells.agg(two(F.sum("_a")).alias("_ca"), two(F.sum("_b")).alias("_cb"))
    n = F.col("_ca") + F.col("_cb")
    r_tot = F.col("_a") + F.col("_b")
    e = attach_row(cells, tot).select(
        "_a", "_b", (r_tot * F.col("_ca") / n).alias("_ea"), (r_tot * F.col("_cb") / n).alias("_eb"))
    e = e.withColumn("_da", F.abs(F.col("_a") - F.col("_ea"))).withColumn(
        "_db", F.abs(F.col("_b") - F.col("_eb")))
    yates = e.agg(F.least(F.lit(0.5), F.min("_da"), F.min("_db")).alias("_y"))
    part = lambda d, ex: (F.col(d) - F.col("_y")) * (F.col(d) - F.col("_y")) / F.col(ex)
    return (attach_row(e, yates)
            .agg(F.sum(part("_da", "_ea") + part("_db", "_eb")).alias("statistic"))
            .select("statistic", F.lit(1).cast("long").alias("parameter"),
                    F.lit(YATES_METHOD).alias("method")))


def chisq_2x2(table: DataFrame, yes: str, no: str) -> DataFrame:
    """``tidy(chisq.test(.))`` on a 2×2 table: statistic, p_value, parameter, method."""
    return chisq_margins(table, yes, no).select(
        "statistic", F.expr(tails.chi2_1df_upper_p("statistic")).alias("p_value"), "parameter", "method")


def extreme_group(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Group with the largest correlation (1 row): group, r (M24 first half).

    One grouped aggregate, then the first row (ties to the smallest key)."""
    per = df.groupBy(group).agg(safe_corr(x, y).alias("r")).filter(F.col("r").isNotNull())
    return first_row(per, "r", group).select(group, "r")


def extreme_group_fit(df: DataFrame, group: str, x: str, y: str):
    """Fit y ~ x on the group whose correlation is largest.

    Correlation and fit both come from the same per-group moments, so the data is read
    once: r is computed on the moment rows, one global ``min_by`` (ties to the smallest
    key) returns the winning group's whole moment row, and only that row is solved.
    """
    mom = moments(df, y, [x], [group])           # index 0 = x, 1 = y
    r = F.when((F.col("c_0_0") > 0) & (F.col("c_1_1") > 0),
               F.col("c_0_1") / F.sqrt(F.col("c_0_0") * F.col("c_1_1")))
    best = first_row(mom.withColumn("_r", r).filter(F.col("_r").isNotNull()), "_r", group).drop("_r")
    return fit_moments(best, y, [x], [group])


def paired_change(df: DataFrame, ids: Sequence[str], period: str, value: str, p1, p2,
                  ) -> DataFrame:
    """Wide table of two periods for the ids present in both (M25 input)."""
    wide = spread(df.filter(F.col(period).isin(p1, p2)), ids, period, value, [p1, p2])
    return wide.filter(F.col(f"`{p1}`").isNotNull() & F.col(f"`{p2}`").isNotNull())


def change_summary(wide: DataFrame, p1, p2) -> DataFrame:
    """Correlation between the periods and the share that did not improve."""
    a, b = F.col(f"`{p1}`"), F.col(f"`{p2}`")
    return wide.agg(F.count("*").alias("n"), safe_corr(a, b).alias("r"),
                    F.avg(((b - a) <= 0).cast("int")).alias("share_not_better"))


__all__ = ["spearman", "corr_excluding", "chisq_2x2", "chisq_margins", "extreme_group",
           "extreme_group_fit", "paired_change", "change_summary"]
