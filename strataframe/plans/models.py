"""Registered queries for regression lines, OLS fits and inference."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from strataframe.functions.columns import safe_div
from strataframe.operators import infer
from strataframe.operators.attach import attach_row
from strataframe.operators.ols import line, line_both, ols, rss_grid
from strataframe.operators.verbs import per_group
from strataframe.plans.basics import GALTON_SQL, RATES_SQL, STRATA_SQL, galton, hr_strata
from strataframe.plans.registry import (
    erfc_sql, f_p_sql, ols_sql_ctes, ols_sql_intercept, ols_sql_tidy, register, t_crit_ctes, t_p_sql,
)
from strataframe.sources.fixtures import admissions, events_xy, sim_panel, team_season
from strataframe.sources.tables import load

TIDY = "estimate std_error statistic"
FIVE = ["BB", "singles", "doubles", "triples", "HR"]
GALTON_CTE = {"galton": GALTON_SQL}


def team_rates_all(spark, d, years=None):
    ts = team_season(spark, d, years)
    return ts.select("teamID", "yearID", safe_div("BB", "G").alias("BB"),
                     safe_div(F.col("H") - F.col("HR") - F.col("X2B") - F.col("X3B"), "G")
                     .alias("singles"),
                     safe_div("X2B", "G").alias("doubles"), safe_div("X3B", "G").alias("triples"),
                     safe_div("HR", "G").alias("HR"), safe_div("R", "G").alias("R"))


def rates_sql(where: str = "") -> str:
    return f"""(select teamID, yearID, BB / G as BB, (H - HR - X2B - X3B) / G as singles,
                X2B / G as doubles, X3B / G as triples, HR / G as HR, R / G as R
                from team_season {where})"""


# ---------------------------------------------------------------- lines from moments
@register("line_xy", """
    select *, intercept + slope * 72 as pred_72 from (
        select mu_x, mu_y, s_x, s_y, r, r * s_y / s_x as slope,
               mu_y - r * s_y / s_x * mu_x as intercept from (
            select avg(father) as mu_x, avg(son) as mu_y, stddev_samp(father) as s_x,
                   stddev_samp(son) as s_y, corr(father, son) as r from galton))""",
    "mu_x mu_y s_x s_y r slope intercept pred_72", GALTON_CTE)
def q_line_xy(spark, d):
    l = line(galton(spark, d), "father", "son")
    return l.withColumn("pred_72", F.col("intercept") + F.col("slope") * 72)


@register("line_yx", """
    select r, r * s_y / s_x as slope_y_on_x, mu_y - r * s_y / s_x * mu_x as intercept_y_on_x,
           r * s_x / s_y as slope_x_on_y, mu_x - r * s_x / s_y * mu_y as intercept_x_on_y
    from (select avg(father) as mu_x, avg(son) as mu_y, stddev_samp(father) as s_x,
                 stddev_samp(son) as s_y, corr(father, son) as r from galton)""",
    "r slope_y_on_x intercept_y_on_x slope_x_on_y intercept_x_on_y", GALTON_CTE)
def q_line_yx(spark, d):
    return line_both(galton(spark, d), "father", "son")


@register("rss_grid", """
    select beta1, n * (my - 36.0 - beta1 * mx) * (my - 36.0 - beta1 * mx) + (n - 1) * vyy
                  - 2.0 * beta1 * (n - 1) * vxy + beta1 * beta1 * (n - 1) * vxx as rss
    from (select 0.0 + (row_number() over (order by child_id) - 1) * ((1.0 - 0.0) / (count(*) over () - 1))
                 as beta1 from galton) g,
         (select count(*) as n, avg(father) as mx, avg(son) as my, var_samp(father) as vxx,
                 covar_samp(father, son) as vxy, var_samp(son) as vyy from galton) m""",
    "beta1 rss", GALTON_CTE)
def q_rss_grid(spark, d):
    return rss_grid(galton(spark, d), "father", "son", 36.0)


# ---------------------------------------------------------------- OLS
def _tidy_sql(prefix, src, y, xs, by=()):
    return ols_sql_tidy(prefix, xs, by), ols_sql_ctes(prefix, src, y, xs, by)


_sql, _ctes = _tidy_sql("f1", "galton", "son", ["father"])


@register("ols1", _sql, TIDY, {**GALTON_CTE, **_ctes})
def q_ols1(spark, d):
    return ols(galton(spark, d), "son", ["father"]).tidy(p_values=False)


_sql, _ctes = _tidy_sql("f1b", STRATA_SQL, "R", ["BB"], ["HR_strata"])


@register("ols1_by", _sql, "HR_strata " + TIDY, _ctes)
def q_ols1_by(spark, d):
    return ols(hr_strata(spark, d), "R", ["BB"], by=["HR_strata"]).tidy(p_values=False)


_sql, _ctes = _tidy_sql("f2", RATES_SQL, "R", ["BB", "HR"])


@register("ols2", _sql, TIDY, _ctes)
def q_ols2(spark, d):
    from strataframe.plans.basics import team_rates
    return ols(team_rates(spark, d), "R", ["BB", "HR"]).tidy(p_values=False)


_sql, _ctes = _tidy_sql("f5", RATES_SQL, "R", FIVE)


@register("ols5", _sql, TIDY, _ctes)
def q_ols5(spark, d):
    from strataframe.plans.basics import team_rates
    return ols(team_rates(spark, d), "R", FIVE).tidy(p_values=False)


LINE_XS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "part_mod"]
LINES_SQL = """(select cast(year(l_shipdate) as integer) as ship_year,
                       l_extendedprice / 1000.0 as price, l_quantity, l_discount, l_tax,
                       cast(l_linenumber as double) as l_linenumber,
                       cast(l_partkey % 100 as double) as part_mod from lineitem)"""
_sql, _ctes = _tidy_sql("f5b", LINES_SQL, "price", LINE_XS, ["ship_year"])


@register("ols5_by", _sql, TIDY, _ctes)
def q_ols5_by(spark, d):
    li = load(spark, d, "lineitem").select(
        F.year("l_shipdate").cast("int").alias("ship_year"),
        (F.col("l_extendedprice") / 1000.0).alias("price"), "l_quantity", "l_discount", "l_tax",
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        (F.col("l_partkey") % 100).cast("double").alias("part_mod"))
    return ols(li, "price", LINE_XS, by=["ship_year"]).tidy(p_values=False)


_ctes = ols_sql_ctes("fp", rates_sql("where yearID between 1995 and 1999"), "R", FIVE)
_b0, _ = ols_sql_intercept(5)
_pred = " + ".join(f"fp_fit.a_{j}_5 * r.{x}" for j, x in enumerate(FIVE))


@register("predict", f"""
    select r.teamID, r.R, ({_b0}) + {_pred} as R_hat
    from {rates_sql('where yearID = 2000')} r, fp_fit""", "R R_hat", _ctes)
def q_predict(spark, d):
    fit = ols(team_rates_all(spark, d, (1995, 1999)), "R", FIVE)
    new = team_rates_all(spark, d, (2000, 2000))
    return fit.predict(new, out="R_hat").select("teamID", "R", "R_hat")


_ctes = {**GALTON_CTE, **ols_sql_ctes("fa", "galton", "son", ["father"])}


@register("augment", """
    select child_id, fitted, resid, hat,
           sqrt((rss - resid * resid / (1 - hat)) / (n - 2 - 1)) as sigma_i,
           resid * resid * hat / (2 * s2 * (1 - hat) * (1 - hat)) as cooksd,
           resid / (sqrt(s2) * sqrt(1 - hat)) as std_resid
    from (select g.child_id, f.*, (m_1 - a_0_1 * m_0) + a_0_1 * g.father as fitted,
                 g.son - ((m_1 - a_0_1 * m_0) + a_0_1 * g.father) as resid,
                 1.0 / n + (g.father - m_0) * (g.father - m_0) * a_0_0 as hat
          from galton g, fa_fit f)""", "fitted resid hat sigma_i cooksd std_resid", _ctes)
def q_augment(spark, d):
    g = galton(spark, d)
    a = ols(g, "son", ["father"]).augment(g)
    return a.select("child_id", "fitted", "resid", "hat", "sigma_i", "cooksd", "std_resid")


_ctes = ols_sql_ctes("fg", RATES_SQL, "R", ["BB", "HR"])


@register("glance", f"""
    select 1 - rss / tss as r_squared, 1 - (rss / tss) * (n - 1) / (n - 3) as adj_r_squared,
           sqrt(s2) as sigma, ((tss - rss) / 2) / s2 as statistic, cast(2 as bigint) as df,
           pow((n - 3) / ((n - 3) + 2 * (((tss - rss) / 2) / s2)), (n - 3) / 2.0) as p_value,
           0.5 * (-n * (ln(2 * pi()) + 1 - ln(n) + ln(rss))) as logLik,
           -2 * 0.5 * (-n * (ln(2 * pi()) + 1 - ln(n) + ln(rss))) + 2 * 4 as AIC,
           -2 * 0.5 * (-n * (ln(2 * pi()) + 1 - ln(n) + ln(rss))) + ln(n) * 4 as BIC,
           rss as deviance, cast(n - 3 as bigint) as df_residual, cast(n as bigint) as nobs
    from fg_fit""", "r_squared adj_r_squared sigma statistic p_value logLik AIC BIC deviance", _ctes)
def q_glance(spark, d):
    from strataframe.plans.basics import team_rates
    return ols(team_rates(spark, d), "R", ["BB", "HR"]).glance()


EV_POLY_SQL = """(select time_c, time_c * time_c as time_sq, observed_distance from (
    select time - avg(time) over () as time_c, observed_distance from events_xy))"""
_sql, _ctes = _tidy_sql("fq", EV_POLY_SQL, "observed_distance", ["time_c", "time_sq"])


@register("poly2", _sql, TIDY, _ctes)
def q_poly2(spark, d):
    """A quadratic in the centred time, as the square of an uncentred one is nearly a multiple of it."""
    e = events_xy(spark, d)
    e = attach_row(e, e.agg(F.avg("time").alias("_mid")))
    e = e.withColumn("time_c", F.col("time") - F.col("_mid"))
    e = e.withColumn("time_sq", F.col("time_c") * F.col("time_c"))
    return ols(e, "observed_distance", ["time_c", "time_sq"]).tidy(p_values=False)


_c1 = ols_sql_ctes("fy", rates_sql(), "R", ["BB", "HR"], ["yearID"])
_c2 = ols_sql_ctes("fs", "(select yearID, a_0_2 as estimate from fy_fit)", "estimate", ["yearID"])


@register("second_stage", ols_sql_tidy("fs", ["yearID"]), TIDY, {**_c1, **_c2})
def q_second_stage(spark, d):
    res = (ols(team_rates_all(spark, d), "R", ["BB", "HR"], by=["yearID"]).coef("BB", p_values=False)
           .select("yearID", "estimate"))
    return ols(res, "estimate", ["yearID"]).tidy(p_values=False)


_sql, _ctes = _tidy_sql("fu", STRATA_SQL, "R", ["BB"])


@register("ols_ungrouped", _sql, TIDY, _ctes)
def q_ols_ungrouped(spark, d):
    """A fit on a grouped table ignores the groups (M7b): no ``by``."""
    return ols(hr_strata(spark, d), "R", ["BB"]).tidy(p_values=False)


_ctes = ols_sql_ctes("fl", STRATA_SQL, "R", ["BB"], ["HR_strata"])
_b0, _se0 = ols_sql_intercept(1)


@register("stacked_results", f"""
    select HR_strata, '(Intercept)' as term, {_b0} as estimate, {_se0} as std_error from fl_fit
    union all
    select HR_strata, 'BB' as term, a_0_1 as estimate, sqrt(s2 * a_0_0) as std_error from fl_fit""",
    "HR_strata estimate std_error", _ctes)
def q_stacked_results(spark, d):
    """Per-group result tables of two rows each, concatenated in group order."""
    t = ols(hr_strata(spark, d), "R", ["BB"], by=["HR_strata"]).tidy(p_values=False)
    return t.select("HR_strata", "term", "estimate", "std_error")


def _inference_sql(prefix: str, tidy: str, k: int, by: str = "") -> str:
    """A tidy table with p_value, conf_low and conf_high, from the quantiles in CTE ``crit``."""
    on = f" and t.{by} = f.{by}" if by else ""
    return f"""(select t.*, case when statistic is not null then {t_p_sql('statistic', f'(f.n - {k + 1})')} end as p_value,
        estimate - t_crit * std_error as conf_low, estimate + t_crit * std_error as conf_high
        from ({tidy}) t join {prefix}_fit f on true{on} left join crit c on c.df = f.n - {k + 1})"""


_sql, _ctes = _tidy_sql("fi", STRATA_SQL, "R", ["BB"], ["HR_strata"])
_ctes = {**_ctes, **t_crit_ctes("select distinct n - 2 as df from fi_fit")}


@register("interval", f"""
    select HR_strata, estimate, conf_low, conf_high, p_value
    from {_inference_sql('fi', _sql, 1, 'HR_strata')} where term = 'BB'""",
    "HR_strata estimate conf_low conf_high p_value", _ctes)
def q_interval(spark, d):
    """Slope with its 95% interval and p-value per stratum."""
    fit = ols(hr_strata(spark, d), "R", ["BB"], by=["HR_strata"])
    return fit.coef("BB", conf_int=True).select("HR_strata", "estimate", "conf_low",
                                                "conf_high", "p_value")


_sql, _ctes = _tidy_sql("fj", RATES_SQL, "R", FIVE)
_ctes = {**_ctes, **t_crit_ctes("select distinct n - 6 as df from fj_fit")}
_f = "((tss - rss) / 5) / s2"


@register("inference", f"""
    select i.*, {_f} as f_statistic, {f_p_sql(f'({_f})', 5, '(n - 6)')} as f_p_value
    from {_inference_sql('fj', _sql, 5)} i, fj_fit""",
    TIDY + " p_value conf_low conf_high f_statistic f_p_value", _ctes)
def q_inference(spark, d):
    """Full coefficient table with p-values and intervals, plus the F-test."""
    from strataframe.plans.basics import team_rates
    fit = ols(team_rates(spark, d), "R", FIVE)
    g = fit.glance().select(F.col("statistic").alias("f_statistic"),
                            F.col("p_value").alias("f_p_value"))
    return attach_row(fit.tidy(conf_int=True), g)


_ctes = {**GALTON_CTE, **ols_sql_ctes("fr", "galton", "son", ["father"])}


@register("summary_fit", """
    select min(resid) as min, quantile_cont(resid, 0.25) as q1, quantile_cont(resid, 0.5) as median,
           quantile_cont(resid, 0.75) as q3, max(resid) as max
    from (select g.son - ((m_1 - a_0_1 * m_0) + a_0_1 * g.father) as resid from galton g, fr_fit)""",
    "min q1 median q3 max", _ctes)
def q_summary_fit(spark, d):
    g = galton(spark, d)
    return ols(g, "son", ["father"]).summary(g)["residuals"]


_tidy_g, _ctes_g = _tidy_sql("fr", "galton", "son", ["father"])
_ctes_g = {**GALTON_CTE, **_ctes_g}
_f_g = "((tss - rss) / s2)"


@register("summary_table", f"""
    select 'residuals' as section, null::varchar as item, measure, value from (
        unpivot (select min(resid) as min, quantile_cont(resid, 0.25) as q1, quantile_cont(resid, 0.5) as median,
                        quantile_cont(resid, 0.75) as q3, max(resid) as max
                 from (select g.son - ((m_1 - a_0_1 * m_0) + a_0_1 * g.father) as resid from galton g, fr_fit))
        on min, q1, median, q3, max into name measure value value)
    union all
    select 'coefficients', term, measure, value from (
        unpivot (select term, estimate, std_error, statistic, {t_p_sql('statistic', '(f.n - 2)')} as p_value from ({_tidy_g}) t, fr_fit f)
        on estimate, std_error, statistic, p_value into name measure value value)
    union all
    select 'fit', null, measure, value from (
        unpivot (select sqrt(s2) as sigma, (n - 2)::double as df_residual, 1 - rss / tss as r_squared, 1 - (rss / tss) * (n - 1) / (n - 2) as adj_r_squared,
                        {_f_g} as statistic, 1.0::double as df, {f_p_sql(_f_g, 1, '(n - 2)')} as p_value from fr_fit)
        on sigma, df_residual, r_squared, adj_r_squared, statistic, df, p_value into name measure value value)""", "value", _ctes_g)
def q_summary_table(spark, d):
    """The whole summary of a fit as one table: residuals, coefficients, statistics."""
    g = galton(spark, d)
    return ols(g, "son", ["father"]).summary_table(g).select("section", "item", "measure", "value")


# ---------------------------------------------------------------- user functions
def _slope_se(pdf: pd.DataFrame) -> pd.DataFrame:
    """User function for one group: slope of R on BB and its standard error."""
    x, y = pdf["BB"].to_numpy(float), pdf["R"].to_numpy(float)
    n = len(x)
    sxx = float(((x - x.mean()) ** 2).sum())
    slope = float(((x - x.mean()) * (y - y.mean())).sum() / sxx) if sxx > 0 else math.nan
    resid = y - (y.mean() + slope * (x - x.mean()))
    se = math.sqrt(float(resid @ resid) / (n - 2) / sxx) if n > 2 and sxx > 0 else math.nan
    return pd.DataFrame({"HR_strata": [pdf["HR_strata"].iloc[0]], "slope": [slope], "se": [se]})


@register("per_group_udf", f"""
    select HR_strata, regr_slope(R, BB) as slope,
           case when count(*) > 2 then sqrt(regr_syy(R, BB) * (1 - regr_r2(R, BB)) / (count(*) - 2)
                                           / regr_sxx(R, BB)) end as se
    from {STRATA_SQL} group by HR_strata""", "HR_strata slope se")
def q_per_group_udf(spark, d):
    """A user function per group returning a table (U1), through applyInPandas."""
    return per_group(hr_strata(spark, d), ["HR_strata"], _slope_se,
                     "HR_strata double, slope double, se double")


_ctes = ols_sql_ctes("fn", STRATA_SQL, "R", ["BB"], ["HR_strata"])


@register("nested_fit_flat", f"""
    select HR_strata, cast(n as bigint) as n, {_b0} as intercept, a_0_1 as slope, {_se0} as se_intercept,
           sqrt(s2 * a_0_0) as se_slope, sqrt(s2) as sigma, 1 - rss / tss as r_squared from fn_fit""",
    "HR_strata intercept slope se_intercept se_slope sigma r_squared", _ctes)
def q_nested_fit_flat(spark, d):
    """The fields of the nested fit as columns."""
    fit = ols(hr_strata(spark, d), "R", ["BB"], by=["HR_strata"])
    nested = fit.fit_df.select("HR_strata", F.struct("n", "coef", "se", "sigma", "r_squared").alias("fit"))
    at = lambda c, i, name: F.col(f"fit.{c}")[i].alias(name)
    return nested.select("HR_strata", "fit.n", at("coef", 0, "intercept"), at("coef", 1, "slope"), at("se", 0, "se_intercept"),
                         at("se", 1, "se_slope"), "fit.sigma", "fit.r_squared")


@register("nested_fit")
def q_nested_fit(spark, d):
    """One fitted model per row as a struct column."""
    from strataframe.plans.registry import round_double

    fit = ols(hr_strata(spark, d), "R", ["BB"], by=["HR_strata"])
    arr = lambda c: F.transform(c, round_double).alias(c)
    return fit.fit_df.select("HR_strata", F.struct(
        "n", arr("coef"), arr("se"), round_double(F.col("sigma")).alias("sigma"),
        round_double(F.col("r_squared")).alias("r_squared")).alias("fit"))


# ---------------------------------------------------------------- inference
AVG_RANK_SQL = """(select event_id,
        rank() over (order by time) + (count(*) over (partition by time) - 1) / 2.0 as rx,
        rank() over (order by observed_distance)
          + (count(*) over (partition by observed_distance) - 1) / 2.0 as ry,
        time, observed_distance from events_xy)"""


@register("spearman", f"""
    select corr(rx, ry) as spearman, corr(time, observed_distance) as pearson
    from {AVG_RANK_SQL}""", "spearman pearson")
def q_spearman(spark, d):
    return infer.spearman(events_xy(spark, d), "time", "observed_distance")


@register("corr_excl", """
    select corr(time, observed_distance) as r_all,
           corr(case when event_id <> 23 then time end,
                case when event_id <> 23 then observed_distance end) as r_without
    from events_xy""", "r_all r_without")
def q_corr_excl(spark, d):
    return infer.corr_excluding(events_xy(spark, d), "time", "observed_distance", "event_id", 23)


def admission_table(spark, d):
    a = admissions(spark, d)
    t = a.groupBy("gender").agg(
        F.bround(F.sum(F.col("admitted") / 100 * F.col("applicants")), 0).alias("total_admitted"),
        F.sum("applicants").alias("_apps"))
    return t.select("gender", "total_admitted",
                    (F.col("_apps") - F.col("total_admitted")).alias("not_admitted"))


CHISQ_SQL = """
    with t as (select gender, round_even(sum(admitted / 100 * applicants), 0) as a,
                      sum(applicants) - round_even(sum(admitted / 100 * applicants), 0) as b
               from admissions group by gender),
         m as (select sum(a) as ca, sum(b) as cb from t),
         e as (select a, b, (a + b) * ca / (ca + cb) as ea, (a + b) * cb / (ca + cb) as eb from t, m),
         y as (select least(0.5, min(abs(a - ea)), min(abs(b - eb))) as yc from e)
    select sum((abs(a - ea) - yc) * (abs(a - ea) - yc) / ea + (abs(b - eb) - yc) * (abs(b - eb) - yc) / eb)
             as statistic, cast(1 as bigint) as parameter,
           'Pearson''s Chi-squared test with Yates'' continuity correction' as method
    from e, y"""


@register("chisq", f"select * from ({CHISQ_SQL})", "statistic")
def q_chisq(spark, d):
    return infer.chisq_margins(admission_table(spark, d), "total_admitted", "not_admitted")


@register("chisq_test", f"""
    select statistic, {erfc_sql('sqrt(statistic / 2)')} as p_value, parameter, method from ({CHISQ_SQL})""", "statistic p_value")
def q_chisq_test(spark, d):
    """``tidy(chisq.test(.))`` including the p-value."""
    return infer.chisq_2x2(admission_table(spark, d), "total_admitted", "not_admitted")


def order_table(spark, d):
    """Orders with four lines or more against the others, by whether they have a returned line: a real difference."""
    li = load(spark, d, "lineitem")
    o = li.groupBy("l_orderkey").agg((F.count("*") >= 4).alias("long"), F.bool_or(F.col("l_returnflag") == "R").alias("back"))
    return o.groupBy("long").agg(F.count_if("back").alias("yes"), F.count_if(~F.col("back")).alias("no"))


ORDER_CHISQ_SQL = f"""
    with t as (select long, count_if(back)::double as a, count_if(not back)::double as b from (
                 select l_orderkey, count(*) >= 4 as long, bool_or(l_returnflag = 'R') as back from lineitem group by 1) group by long),
    {CHISQ_SQL[CHISQ_SQL.index("m as"):]}"""


@register("chisq_orders", f"""
    select statistic, {erfc_sql('sqrt(statistic / 2)')} as p_value, parameter, method from ({ORDER_CHISQ_SQL})""", "statistic p_value")
def q_chisq_orders(spark, d):
    """The chi-square test on counts that differ: a large statistic, a p-value far below any absolute step."""
    return infer.chisq_2x2(order_table(spark, d), "yes", "no")


_ctes = ols_sql_ctes("fx", """(select * from sim_panel where "group" = (
            select arg_min("group", -r) from (select "group", corr(x, y) as r from sim_panel
                                              group by "group")))""", "y", ["x"], ["group"])


@register("extreme_group", ols_sql_tidy("fx", ["x"], ["group"]), TIDY, _ctes)
def q_extreme_group(spark, d):
    fit = infer.extreme_group_fit(sim_panel(spark, d), "group", "x", "y")
    return fit.tidy(p_values=False)


@register("extreme_r", """
    select "group", corr(x, y) as r from sim_panel group by "group"
    order by r desc, "group" limit 1""", "r")
def q_extreme_r(spark, d):
    """Most extreme correlation among all groups of the panel (M24, first half)."""
    return infer.extreme_group(sim_panel(spark, d), "group", "x", "y")


def qualified_avg(spark, d, years=(1996, 1997), min_ab=2000):
    """Per (player, season) batting average of qualified seasons only (P11 + A5)."""
    from strataframe.operators.verbs import filter_group
    from strataframe.sources.fixtures import batting

    b = batting(spark, d, years)
    q = filter_group(b, ["playerID", "yearID"], [F.sum("AB").alias("_ab")],
                     F.col("_ab") >= min_ab)
    return q.groupBy("playerID", "yearID").agg(safe_div(F.sum("H"), F.sum("AB")).alias("AVG"))


QUALIFIED_SQL = """(select playerID, yearID, sum(H) / sum(AB) as AVG from batting
                    where yearID between 1996 and 1997 group by playerID, yearID
                    having sum(AB) >= 2000)"""
PAIRED_SQL = f"""(select * from (select playerID,
                        max(case when yearID = 1996 then AVG end) as "1996",
                        max(case when yearID = 1997 then AVG end) as "1997"
                  from {QUALIFIED_SQL} group by playerID)
                  where "1996" is not null and "1997" is not null)"""


@register("paired_change", f"""
    select count(*) as n, corr("1996", "1997") as r,
           avg(case when "1997" - "1996" <= 0 then 1 else 0 end) as share_not_better
    from {PAIRED_SQL}""", "r share_not_better")
def q_paired_change(spark, d):
    wide = infer.paired_change(qualified_avg(spark, d), ["playerID"], "yearID", "AVG", 1996, 1997)
    return infer.change_summary(wide, 1996, 1997)


__all__ = ["team_rates_all", "rates_sql", "qualified_avg", "PAIRED_SQL", "QUALIFIED_SQL"]


# ---------------------------------------------------------------- outliers
OUTLIER_SEED, OUTLIER_ROW = 1985, 23


def outlier_vectors(spark, d):
    """x ~ N(100, 1), y ~ N(84, 1) per event; every row but one standardised."""
    from strataframe.functions.columns import normal_pair
    from strataframe.operators.scale import zscore

    ev = events_xy(spark, d).select("event_id")
    x, y = normal_pair(OUTLIER_SEED, "event_id")
    v = ev.select("event_id", (F.lit(100.0) + x).alias("x"), (F.lit(84.0) + y).alias("y"))
    keep = F.col("event_id") != OUTLIER_ROW
    v = zscore(v, "x", out="x", where=keep)
    return zscore(v, "y", out="y", where=keep)


def _outlier_sql():
    from strataframe.functions.columns import normal_pair_sql
    x, y = normal_pair_sql(OUTLIER_SEED, "event_id")
    raw = f"(select event_id, 100.0 + {x} as x, 84.0 + {y} as y from events_xy)"
    z = lambda c: (f"case when event_id <> {OUTLIER_ROW} then ({c} - avg({c}) filter "  # noqa: E731
                   f"(where event_id <> {OUTLIER_ROW}) over ()) / stddev_samp({c}) filter "
                   f"(where event_id <> {OUTLIER_ROW}) over () else {c} end")
    return f"(select event_id, {z('x')} as x, {z('y')} as y from {raw})"


@register("outliers", f"""
    select corr(x, y) as r_all,
           corr(case when event_id <> {OUTLIER_ROW} then x end,
                case when event_id <> {OUTLIER_ROW} then y end) as r_without,
           corr(rx, ry) as spearman
    from (select event_id, x, y,
                 rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0 as rx,
                 rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0 as ry
          from {_outlier_sql()})""", "r_all r_without spearman")
def q_outliers(spark, d):
    """The outlier study: Pearson with and without the odd row, and Spearman."""
    v = outlier_vectors(spark, d)
    c = infer.corr_excluding(v, "x", "y", "event_id", OUTLIER_ROW)
    s = infer.spearman(v, "x", "y").select("spearman")
    return attach_row(c, s)
