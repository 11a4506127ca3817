"""Ordinary least squares from mergeable moments.

The data-sized work is one ``groupBy(by).agg(count, avg, covar_samp of every pair)``: Spark
plans it as partial + final hash aggregation, so a hot group is pre-aggregated on every map
task and costs no more than a cold one. The solve runs in ``mapInPandas`` over the moment
rows (one per group), vectorised across groups with the sweep operator. Prediction,
augment and standard errors are Column arithmetic on the broadcast (or key-joined) fit row.

Aliased predictors (constant or collinear) get a NULL estimate, as R's ``lm`` reports NA.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.functions import tails
from strataframe.operators.attach import join_by
from strataframe.functions.columns import pair_corr, slope_moments, strict

INTERCEPT = "(Intercept)"
#: Fits of up to so many predictors are solved by Column arithmetic; larger ones by the same sweep in numpy.
COLUMN_PREDICTORS = 2
ALIAS_TOL = 1e-7  # on norms: a predictor whose residual norm is below this share of its own is aliased


def moments(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group: n, means and sample covariances of (x1..xk, y).

    Rows with a NULL in any model column are dropped first (R's ``na.omit`` for ``lm``).
    """
    cols = [*xs, y]
    d = df.select(*by, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    # Complete cases by masking inside the aggregate rather than a Filter: a Filter would be
    # pushed below the projection and evaluate every model-column expression twice.
    complete = F.lit(True)
    for i in range(len(cols)):
        complete = complete & F.col(f"_v{i}").isNotNull()
    v = [F.when(complete, F.col(f"_v{i}")) for i in range(len(cols))]
    aggs = [F.count_if(complete).alias("n")]
    aggs += [F.avg(v[i]).alias(f"m_{i}") for i in range(len(cols))]
    aggs += [F.covar_samp(v[i], v[j]).alias(f"c_{i}_{j}")
             for i in range(len(cols)) for j in range(i, len(cols))]
    mom = d.groupBy(*by).agg(*aggs)
    return mom.filter(F.col("n") > 0) if by else mom


def _fit_schema(by_fields: str) -> str:
    arr = "array<double>"
    return (f"{by_fields}n long, rank int, df_residual long, rss double, tss double, "
            f"sigma double, r_squared double, adj_r_squared double, f_statistic double, "
            f"log_lik double, aic double, bic double, ybar double, "
            f"coef {arr}, se {arr}, t {arr}, "
            f"xbar {arr}, inv {arr}")


def _nan_to_none(a: np.ndarray) -> list:
    return [None if not np.isfinite(v) else float(v) for v in a]


def solve_moments(batch: pd.DataFrame, k: int, tol: float = ALIAS_TOL):
    """Vectorised sweep-operator solve of a batch of moment rows (pure numpy), without the tails."""
    g = len(batch)
    n = batch["n"].to_numpy(dtype=float)
    m = k + 1
    mean = np.stack([batch[f"m_{i}"].to_numpy(dtype=float) for i in range(m)], axis=1)
    cov = np.zeros((g, m, m))
    for i in range(m):
        for j in range(i, m):
            v = np.nan_to_num(batch[f"c_{i}_{j}"].to_numpy(dtype=float), nan=0.0)
            cov[:, i, j] = v
            cov[:, j, i] = v
    a = cov * (n - 1.0)[:, None, None]
    diag0 = np.array([a[:, p, p] for p in range(k)]).T.reshape(g, k)
    swept = np.zeros((g, k), dtype=bool)
    for p in range(k):
        d = a[:, p, p]
        ok = (diag0[:, p] > 0) & (d > tol * tol * diag0[:, p])
        dd = np.where(ok, d, 1.0)
        row = a[:, p, :] / dd[:, None]
        colp = a[:, :, p].copy()
        b = a - colp[:, :, None] * row[:, None, :]
        b[:, p, :] = row
        b[:, :, p] = -colp / dd[:, None]
        b[:, p, p] = 1.0 / dd
        a = np.where(ok[:, None, None], b, a)
        swept[:, p] = ok
    rank = swept.sum(axis=1)
    df_res = n - rank - 1.0
    rss = np.maximum(a[:, k, k], 0.0)
    tss = cov[:, k, k] * (n - 1.0)
    with np.errstate(invalid="ignore", divide="ignore"):
        sigma2 = np.where(df_res > 0, rss / np.where(df_res > 0, df_res, 1.0), np.nan)
        beta = np.where(swept, a[:, :k, k], np.nan)
        mask2 = swept[:, :, None] & swept[:, None, :]
        inv = np.where(mask2, a[:, :k, :k], 0.0)
        xbar, ybar = mean[:, :k], mean[:, k]
        b_used = np.where(swept, beta, 0.0)
        intercept = ybar - (b_used * xbar).sum(axis=1)
        var_int = sigma2 * (1.0 / n + np.einsum("gi,gij,gj->g", xbar, inv, xbar))
        diag_inv = np.einsum("gii->gi", inv) if k else np.zeros((g, 0))
        se_b = np.where(swept, np.sqrt(sigma2[:, None] * diag_inv), np.nan)
        coef = np.concatenate([intercept[:, None], beta], axis=1)
        se = np.concatenate([np.sqrt(var_int)[:, None], se_b], axis=1)
        tstat = coef / se
        r2 = np.where(tss > 0, 1.0 - rss / np.where(tss > 0, tss, 1.0), np.nan)
        adj = np.where(df_res > 0, 1.0 - (1.0 - r2) * (n - 1.0) / df_res, np.nan)
        mss = np.maximum(tss - rss, 0.0)
        fstat = np.where((rank > 0) & (df_res > 0), (mss / np.maximum(rank, 1)) / sigma2, np.nan)
        ll = np.where(rss > 0, 0.5 * (-n * (math.log(2 * math.pi) + 1.0 - np.log(n)
                                             + np.log(np.where(rss > 0, rss, 1.0)))), np.nan)
        aic = -2.0 * ll + 2.0 * (rank + 2.0)
        bic = -2.0 * ll + np.log(n) * (rank + 2.0)
    out = pd.DataFrame({
        "n": n.astype("int64"), "rank": rank.astype("int32"), "df_residual": df_res.astype("int64"),
        "rss": rss, "tss": tss, "sigma": np.sqrt(sigma2), "r_squared": r2,
        "adj_r_squared": adj, "f_statistic": fstat, "log_lik": ll,
        "aic": aic, "bic": bic, "ybar": ybar,
        "coef": [_nan_to_none(r) for r in coef], "se": [_nan_to_none(r) for r in se],
        "t": [_nan_to_none(r) for r in tstat],
        "xbar": [_nan_to_none(r) for r in xbar],
        "inv": [_nan_to_none(r.reshape(-1)) for r in inv],
    })
    return out


def solve_columns(mom: DataFrame, k: int, by: Sequence[str], tol: float = ALIAS_TOL) -> DataFrame:
    """``solve_moments`` as Column arithmetic: the sweep of each predictor is one
    projection, so a fit with few predictors has no Python stage."""
    m = k + 1
    at = lambda step, i, j: F.col(f"_a{step}_{i}_{j}")
    cells = [(i, j) for i in range(m) for j in range(m)]
    n, names = F.col("n").cast("double"), [c for c in mom.columns if not c.startswith("c_")]
    work = mom.select(*names, *[(F.coalesce(F.col(f"c_{min(c)}_{max(c)}"), F.lit(0.0)) * (n - 1)).alias("_a0_%d_%d" % c) for c in cells])
    for p in range(k):
        work = work.withColumn(f"_ok{p}", (at(0, p, p) > 0) & (at(p, p, p) > tol * tol * at(0, p, p)))
        ok = F.col(f"_ok{p}")
        pivot = F.when(ok, at(p, p, p)).otherwise(F.lit(1.0))

        def swept(i: int, j: int) -> Column:
            if i == j == p:
                return 1.0 / pivot
            if i == p:
                return at(p, p, j) / pivot
            if j == p:
                return -at(p, i, p) / pivot
            return at(p, i, j) - at(p, i, p) * at(p, p, j) / pivot

        work = work.select("*", *[F.when(ok, swept(*c)).otherwise(at(p, *c)).alias(f"_a{p + 1}_%d_%d" % c) for c in cells])
    ok = [F.col(f"_ok{p}") for p in range(k)]
    rank = sum((o.cast("int") for o in ok), F.lit(0))
    rss, tss = F.greatest(at(k, k, k), F.lit(0.0)), F.col(f"_a0_{k}_{k}")
    beta = [F.when(ok[i], at(k, i, k)) for i in range(k)]
    inv = [[F.when(ok[i] & ok[j], at(k, i, j)).otherwise(F.lit(0.0)) for j in range(k)] for i in range(k)]
    work = work.select("*", rank.alias("rank"), rss.alias("rss"), tss.alias("tss"), F.array(*beta).alias("_beta"),
                       F.array(*[e for row in inv for e in row]).alias("inv"),
                       F.array(*[F.col(f"m_{i}") for i in range(k)]).alias("xbar"), F.col(f"m_{k}").alias("ybar"))
    dfr = (n - F.col("rank") - 1).cast("long")
    work = work.withColumn("df_residual", dfr).withColumn("_s2", F.when(F.col("df_residual") > 0, F.col("rss") / F.col("df_residual")))
    x, iv, s2 = (lambda i: F.col("xbar")[i]), (lambda i, j: F.col("inv")[i * k + j]), F.col("_s2")
    intercept = F.col("ybar") - sum((F.coalesce(F.col("_beta")[i], F.lit(0.0)) * x(i) for i in range(k)), F.lit(0.0))
    quad = sum((x(i) * x(j) * iv(i, j) for i in range(k) for j in range(k)), F.lit(0.0))
    se = [F.sqrt(s2 * (1.0 / n + quad)), *[F.when(ok[i], F.sqrt(s2 * iv(i, i))) for i in range(k)]]
    work = work.withColumn("coef", F.concat(F.array(intercept), F.col("_beta"))).withColumn("se", F.array(*se))
    mss = F.greatest(F.col("tss") - F.col("rss"), F.lit(0.0))
    r2 = F.when(F.col("tss") > 0, 1.0 - F.col("rss") / F.col("tss"))
    f = F.when((F.col("rank") > 0) & (F.col("df_residual") > 0),
               F.when(s2 > 0, mss / F.col("rank") / s2).when(mss > 0, F.lit(float("inf"))))
    ll = F.when(F.col("rss") > 0, 0.5 * (-n * (math.log(2 * math.pi) + 1.0 - F.ln(n) + F.ln("rss"))))
    work = work.withColumn("log_lik", ll)
    t = F.transform(F.arrays_zip("coef", "se"), lambda z: F.try_divide(z["coef"], z["se"]))
    return work.select(
        *by, "n", "rank", "df_residual", "rss", "tss", F.sqrt(s2).alias("sigma"), r2.alias("r_squared"),
        F.when(F.col("df_residual") > 0, 1.0 - (1.0 - r2) * (n - 1) / F.col("df_residual")).alias("adj_r_squared"),
        f.alias("f_statistic"), "log_lik", (-2.0 * F.col("log_lik") + 2.0 * (F.col("rank") + 2)).alias("aic"),
        (-2.0 * F.col("log_lik") + F.ln(n) * (F.col("rank") + 2)).alias("bic"), "ybar",
        "coef", "se", t.alias("t"), "xbar", "inv")


def with_tails(solved: DataFrame, conf_level: float) -> DataFrame:
    """p-values, t quantile, intervals and the F-test's p-value of solved fits, as Column arithmetic."""
    p = F.expr(f"transform(t, x -> {tails.t_two_sided_p('x', 'df_residual')})")
    out = solved.select("*", p.alias("p"), F.expr(tails.t_critical(conf_level, "df_residual")).alias("t_crit"),
                        F.expr(tails.f_upper_p("f_statistic", "rank", "df_residual")).alias("f_p_value"))
    ends = F.arrays_zip("coef", "se")
    low = F.transform(ends, lambda z: z["coef"] - F.col("t_crit") * z["se"])
    return out.select("*", low.alias("conf_low"), F.transform(ends, lambda z: z["coef"] + F.col("t_crit") * z["se"]).alias("conf_high"))


class Fit:
    """A fitted linear model per group; every view of it is a lazy DataFrame."""

    def __init__(self, solved, y: str, xs: Sequence[str], by: Sequence[str], conf_level: float):
        self._solved, self.y, self.xs, self.by = solved, y, list(xs), list(by)
        self.conf_level = conf_level
        self.terms = [INTERCEPT, *self.xs]

    @property
    def fit_df(self) -> DataFrame:
        """One row per group, without the tails."""
        return self._solved()

    @property
    def inference_df(self) -> DataFrame:
        """One row per group with p-values, t quantile and intervals."""
        return with_tails(self._solved(), self.conf_level)

    # -------------------------------------------------------------- tables
    def tidy(self, conf_int: bool = False, p_values: bool = True) -> DataFrame:
        """term, estimate, std_error, statistic[, p_value][, conf_low, conf_high]."""
        names = F.array(*[F.lit(t) for t in self.terms])
        source = self.inference_df if conf_int or p_values else self.fit_df
        more = (["p"] if p_values else []) + (["conf_low", "conf_high"] if conf_int else [])
        ex = source.select(*self.by, F.posexplode("coef").alias("_i", "estimate"), "se", "t", *more)
        cols = [*self.by, F.element_at(names, F.col("_i") + 1).alias("term"), "estimate",
                F.col("se")[F.col("_i")].alias("std_error"),
                F.col("t")[F.col("_i")].alias("statistic")]
        if p_values:
            cols.append(F.col("p")[F.col("_i")].alias("p_value"))
        if conf_int:
            cols += [F.col("conf_low")[F.col("_i")].alias("conf_low"),
                     F.col("conf_high")[F.col("_i")].alias("conf_high")]
        return ex.select(*cols)

    def coef(self, term: str, conf_int: bool = False, p_values: bool = True) -> DataFrame:
        """One term's row per group."""
        return self.tidy(conf_int, p_values).filter(F.col("term") == term)

    def glance(self, p_values: bool = True) -> DataFrame:
        """Whole-fit statistics."""
        cols = [*self.by, "r_squared", "adj_r_squared", "sigma",
                F.col("f_statistic").alias("statistic")]
        if p_values:
            cols.append(F.col("f_p_value").alias("p_value"))
        cols += [F.col("rank").cast("long").alias("df"), F.col("log_lik").alias("logLik"),
                 F.col("aic").alias("AIC"), F.col("bic").alias("BIC"),
                 F.col("rss").alias("deviance"), "df_residual", F.col("n").alias("nobs")]
        return (self.inference_df if p_values else self.fit_df).select(*cols)

    # -------------------------------------------------------------- rows
    def _attach(self, df: DataFrame) -> DataFrame:
        f = self.fit_df.select(*self.by, F.col("coef").alias("_coef"),
                               F.col("xbar").alias("_xbar"), F.col("inv").alias("_inv"),
                               F.col("sigma").alias("_sigma"), F.col("n").alias("_n"),
                               F.col("rss").alias("_rss"), F.col("rank").alias("_rank"),
                               F.col("df_residual").alias("_dfr"))
        return join_by(df, f, self.by)  # one row per group: AQE picks broadcast or shuffle

    def _fitted(self) -> Column:
        e = F.col("_coef")[0]
        for j, x in enumerate(self.xs):
            e = e + F.coalesce(F.col("_coef")[j + 1], F.lit(0.0)) * F.col(x)
        return e

    def _leverage_core(self) -> Column:
        k = len(self.xs)
        terms = []
        for i in range(k):
            di = F.col(self.xs[i]) - F.col("_xbar")[i]
            for j in range(k):
                dj = F.col(self.xs[j]) - F.col("_xbar")[j]
                terms.append(di * dj * F.coalesce(F.col("_inv")[i * k + j], F.lit(0.0)))
        q = terms[0] if terms else F.lit(0.0)
        for t in terms[1:]:
            q = q + t
        return F.lit(1.0) / F.col("_n") + q

    def predict(self, df: DataFrame, out: str = "fitted", se: bool = False) -> DataFrame:
        """Predictions for new rows (M8); ``se=True`` adds se_fit, df and residual_scale."""
        d = self._attach(df).withColumn(out, self._fitted())
        if se:
            d = (d.withColumn("se_fit", F.col("_sigma") * F.sqrt(self._leverage_core()))
                 .withColumn("df", F.col("_dfr")).withColumn("residual_scale", F.col("_sigma")))
        return d.drop("_coef", "_xbar", "_inv", "_sigma", "_n", "_rss", "_rank", "_dfr")

    def augment(self, df: DataFrame) -> DataFrame:
        """Per-row fitted, resid, hat, sigma_i, cooksd, std_resid."""
        d = self._attach(df.dropna(subset=[self.y, *self.xs]))
        d = (d.withColumn("fitted", self._fitted())
             .withColumn("resid", F.col(self.y) - F.col("fitted"))
             .withColumn("hat", self._leverage_core()))
        one_m_h = F.lit(1.0) - F.col("hat")
        d = (d.withColumn("sigma_i", F.sqrt(F.try_divide(
                F.col("_rss") - F.col("resid") * F.col("resid") / one_m_h, F.col("_dfr") - 1)))
             .withColumn("cooksd", F.try_divide(
                 F.col("resid") * F.col("resid") * F.col("hat"),
                 (F.col("_rank") + 1) * F.col("_sigma") * F.col("_sigma") * one_m_h * one_m_h))
             .withColumn("std_resid", F.try_divide(F.col("resid"),
                                                   F.col("_sigma") * F.sqrt(one_m_h))))
        return d.drop("_coef", "_xbar", "_inv", "_sigma", "_n", "_rss", "_rank", "_dfr")

    def _residual_quantiles(self, df: DataFrame) -> DataFrame:
        from strataframe.operators.ranks import quantiles

        return quantiles(self.augment(df), "resid", [0.0, 0.25, 0.5, 0.75, 1.0], self.by,
                         ["min", "q1", "median", "q3", "max"])

    def summary(self, df: DataFrame) -> dict:
        """Residual five-number summary + coefficient table + fit statistics (M17), as three tables."""
        return {"residuals": self._residual_quantiles(df), "coefficients": self.tidy(), "fit": self.glance()}

    def summary_table(self, df: DataFrame) -> DataFrame:
        """The whole summary as one table: (by..., section, item, measure, value)."""
        def long(table: DataFrame, section: str, item: Column, measures: Sequence[str]) -> DataFrame:
            rows = table.select(*self.by, F.lit(section).alias("section"), item.alias("item"), *[F.col(m).cast("double").alias(m) for m in measures])
            return rows.unpivot([*self.by, "section", "item"], list(measures), "measure", "value")

        none = F.lit(None).cast("string")
        parts = [long(self._residual_quantiles(df), "residuals", none, ["min", "q1", "median", "q3", "max"]),
                 long(self.tidy(), "coefficients", F.col("term"), ["estimate", "std_error", "statistic", "p_value"]),
                 long(self.glance(), "fit", none, ["sigma", "df_residual", "r_squared", "adj_r_squared", "statistic", "df", "p_value"])]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


def ols(df: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (),
        conf_level: float = 0.95) -> Fit:
    """Fit ``y ~ xs`` (+ intercept) per group of ``by`` (M5, M6, M7; M7b when by is empty)."""
    return fit_moments(moments(df, y, xs, by), y, xs, by, conf_level)


def fit_moments(mom: DataFrame, y: str, xs: Sequence[str], by: Sequence[str] = (),
                conf_level: float = 0.95) -> Fit:
    """Solve moment rows (from ``moments``) into a ``Fit``; only these rows reach Python."""
    from strataframe.session import ship_package

    ship_package(mom.sparkSession)
    by, xs = list(by), list(xs)
    by_fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, "
                        for f in mom.schema.fields if f.name in by)
    k = len(xs)

    def solved() -> DataFrame:
        if k <= COLUMN_PREDICTORS:
            return solve_columns(mom, k, by)

        def run(batches):
            for b in batches:
                if len(b) == 0:
                    continue
                out = solve_moments(b, k)
                for c in reversed(by):
                    out.insert(0, c, b[c].to_numpy())
                yield out

        return mom.mapInPandas(run, _fit_schema(by_fields))

    return Fit(solved, y, xs, by, conf_level)


# ------------------------------------------------------------------ moment-form lines
def line(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Regression line from moments: m = r·s_y/s_x, b = ȳ − m·x̄ (M1)."""
    stats = df.groupBy(*by).agg(
        strict(F.avg(x), x).alias("mu_x"), strict(F.avg(y), y).alias("mu_y"),
        strict(F.stddev_samp(x), x).alias("s_x"), strict(F.stddev_samp(y), y).alias("s_y"),
        strict(pair_corr(x, y), x, y).alias("r"))
    slope = F.col("r") * F.try_divide(F.col("s_y"), F.col("s_x"))
    return (stats.withColumn("slope", slope)
            .withColumn("intercept", F.col("mu_y") - F.col("slope") * F.col("mu_x")))


def line_both(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Both regression lines: y on x and x on y (M2)."""
    l = line(df, x, y, by)
    return l.select(*by, "r", F.col("slope").alias("slope_y_on_x"),
                    F.col("intercept").alias("intercept_y_on_x"),
                    (F.col("r") * F.try_divide(F.col("s_x"), F.col("s_y"))).alias("slope_x_on_y"),
                    (F.col("mu_x") - F.col("r") * F.try_divide(F.col("s_x"), F.col("s_y"))
                     * F.col("mu_y")).alias("intercept_x_on_y"))


def slope_by(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Per-stratum slope written as cor·sd(y)/sd(x) (M4): NULL when y is constant."""
    return df.groupBy(*by).agg(slope_moments(x, y).alias("slope"))


def rss_grid(df: DataFrame, x: str, y: str, beta0: float,
             lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """RSS(beta0, beta1) over ``seq(lo, hi, len = nrow(df))``.

    One pass of moments (n, x̄, ȳ, Sxx, Sxy, Syy); the grid is counted up from the moment row, and
    RSS = n(ȳ−β0−β1x̄)² + Syy − 2β1Sxy + β1²Sxx. No data × grid product, no sort.
    """
    from strataframe.sources.tables import grid

    mom = df.agg(F.count("*").alias("_n"), F.avg(x).alias("_mx"), F.avg(y).alias("_my"),
                 F.covar_samp(x, x).alias("_vxx"), F.covar_samp(x, y).alias("_vxy"),
                 F.covar_samp(y, y).alias("_vyy"))
    g = grid(mom, "_n", lo, hi, "beta1")
    n1 = F.col("_n") - 1
    b1 = F.col("beta1")
    resid_mean = F.col("_my") - F.lit(beta0) - b1 * F.col("_mx")
    rss = (F.col("_n") * resid_mean * resid_mean + n1 * F.col("_vyy")
           - 2.0 * b1 * n1 * F.col("_vxy") + b1 * b1 * n1 * F.col("_vxx"))
    return g.select("beta1", rss.alias("rss"))
