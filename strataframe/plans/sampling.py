"""Registered queries for seeded sampling, the bootstrap and the plot statistics
(S4, S5, X1–X6, U8, V1–V8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions.columns import norm_ppf_sql, rnd, uniform_sql
from strataframe.operators import binning, resample, scale
from strataframe.operators.attach import attach_row
from strataframe.operators.aggs import yes_no
from strataframe.operators.reshape import gather
from strataframe.plans.basics import GALTON_SQL, STRATA_SQL, galton, hr_strata
from strataframe.plans.registry import ols_sql_ctes, ols_sql_intercept, register, t_crit_ctes
from strataframe.sources.fixtures import admissions, children, events_xy, sim_panel

GALTON_CTE = {"galton": GALTON_SQL}
B, N = 1000, 50                    # replicates × sample size of the bootstrap
SEED_SAMPLE, SEED_BOOT_R, SEED_BOOT_OLS, SEED_FAMILY = 0, 1, 2, 1989


def _draws_sql(seed: int, n_draws: int, per_rep: int | None = None) -> str:
    rep = f", cast(floor(range / {per_rep}) as bigint) as rep" if per_rep else ""
    return f"""(select range as draw{rep},
                       cast(floor({uniform_sql(seed, 'range')} * m) as bigint) as _row
                from range({n_draws}), (select count(*) as m from galton))"""


INDEXED_SQL = f"""(select *, row_number() over (order by floor({uniform_sql(resample.BUCKET_SEED, 'child_id')} * {resample.BUCKETS}), child_id) - 1 as _row from galton)"""


@register("sample_per_group", f"""
    select family, child_id, mother, childHeight as daughter from family
    where gender = 'female'
    qualify row_number() over (partition by family
                               order by {uniform_sql(SEED_FAMILY, 'child_id')}) = 1""",
    "mother daughter")
def q_sample_per_group(spark, d):
    f = children(spark, d).filter(F.col("gender") == "female")
    one = resample.sample_per_group(f, ["family"], SEED_FAMILY, "child_id")
    return one.select("family", "child_id", "mother", F.col("childHeight").alias("daughter"))


@register("sample_n", f"""
    select d.draw, i.child_id, i.father, i.son
    from {_draws_sql(SEED_SAMPLE, 25)} d join {INDEXED_SQL} i using (_row)""",
    "father son", GALTON_CTE)
def q_sample_n(spark, d):
    s = resample.sample_n(galton(spark, d), 25, SEED_SAMPLE, "child_id")
    return s.select("draw", "child_id", "father", "son")


@register("boot_corr", f"""
    select rep, corr(father, son) as r
    from {_draws_sql(SEED_BOOT_R, B * N, N)} d join {INDEXED_SQL} i using (_row)
    group by rep""", "r", GALTON_CTE)
def q_boot_corr(spark, d):
    return resample.boot_corr(galton(spark, d), "father", "son", B, N, SEED_BOOT_R, "child_id")


@register("boot_ols", f"""
    select rep, regr_intercept(son, father) as beta_0, regr_slope(son, father) as beta_1
    from {_draws_sql(SEED_BOOT_OLS, B * N, N)} d join {INDEXED_SQL} i using (_row)
    group by rep""", "beta_0 beta_1", GALTON_CTE)
def q_boot_ols(spark, d):
    return resample.boot_ols(galton(spark, d), "son", "father", B, N, SEED_BOOT_OLS, "child_id")


@register("boot_se", f"""
    select mean_r, se_r, sqrt((1 - mean_r * mean_r) / {float(N - 2)!r}) as approx_se_r,
           mean_beta_0, se_beta_0, mean_beta_1, se_beta_1
    from (select avg(r) as mean_r, stddev_samp(r) as se_r from (
            select rep, corr(father, son) as r
            from {_draws_sql(SEED_BOOT_R, B * N, N)} d join {INDEXED_SQL} i using (_row)
            group by rep)),
         (select avg(beta_0) as mean_beta_0, stddev_samp(beta_0) as se_beta_0,
                 avg(beta_1) as mean_beta_1, stddev_samp(beta_1) as se_beta_1 from (
            select rep, regr_intercept(son, father) as beta_0, regr_slope(son, father) as beta_1
            from {_draws_sql(SEED_BOOT_OLS, B * N, N)} d join {INDEXED_SQL} i using (_row)
            group by rep))""",
    "mean_r se_r approx_se_r mean_beta_0 se_beta_0 mean_beta_1 se_beta_1", GALTON_CTE)
def q_boot_se(spark, d):
    g = galton(spark, d)
    r = resample.boot_se(resample.boot_corr(g, "father", "son", B, N, SEED_BOOT_R, "child_id"),
                         ["r"])
    r = r.withColumn("approx_se_r", resample.corr_se(F.col("mean_r"), N))
    co = resample.boot_se(resample.boot_ols(g, "son", "father", B, N, SEED_BOOT_OLS, "child_id"),
                          ["beta_0", "beta_1"])
    return attach_row(r, co)


@register("normal_panel", """select "group", i, x, y from sim_panel""", "x y")
def q_normal_panel(spark, d):
    return sim_panel(spark, d).select("group", "i", "x", "y")


# ---------------------------------------------------------------- plot statistics
@register("histogram", """
    with c as (select cast(ceil(observed_distance / 25.0 - 0.5) as bigint) as bin,
                      count(*) as count
               from events_xy where observed_distance is not null group by 1),
         s as (select min(bin) as lo, max(bin) as hi from c)
    select g.bin, g.bin * 25.0 as x, (g.bin - 0.5) * 25.0 as xmin, (g.bin + 0.5) * 25.0 as xmax,
           coalesce(c.count, 0) as count
    from (select unnest(generate_series(lo, hi)) as bin from s) g left join c using (bin)""",
    "x xmin xmax")
def q_histogram(spark, d):
    return binning.histogram(events_xy(spark, d), "observed_distance", 25.0)


@register("boxplot", """
    with q as (select round_even(father, 0) as father_strata,
                      quantile_cont(son, 0.25) as q1, quantile_cont(son, 0.5) as median,
                      quantile_cont(son, 0.75) as q3
               from galton group by 1),
         r as (select round_even(g.father, 0) as father_strata, g.son, q.q1, q.q3
               from galton g join q on round_even(g.father, 0) = q.father_strata)
    select q.father_strata, q.q1, q.median, q.q3, w.ymin, w.ymax, w.n_outliers, w.n
    from q join (
        select father_strata,
               min(case when son between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then son end) as ymin,
               max(case when son between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then son end) as ymax,
               cast(count_if(not (son between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as bigint)
                 as n_outliers,
               count(*) as n
        from r group by father_strata) w using (father_strata)""",
    "father_strata q1 median q3 ymin ymax", GALTON_CTE)
def q_boxplot(spark, d):
    g = galton(spark, d).withColumn("father_strata", rnd("father", 0))
    return binning.boxplot(g, "son", ["father_strata"]).select(
        "father_strata", "q1", "median", "q3", "ymin", "ymax", "n_outliers", "n")


@register("box_outliers", """
    select e.event_id, e.event_type, e.observed_distance from events_xy e
    join (select event_type, quantile_cont(observed_distance, 0.25) as q1,
                 quantile_cont(observed_distance, 0.75) as q3 from events_xy group by 1) q
      using (event_type)
    where e.observed_distance < q1 - 1.5 * (q3 - q1) or e.observed_distance > q3 + 1.5 * (q3 - q1)""",
    "observed_distance")
def q_box_outliers(spark, d):
    e = events_xy(spark, d).select("event_id", "event_type", "observed_distance")
    return binning.box_outliers(e, "observed_distance", ["event_type"])


_P = "((rn - a) / (n + 1 - 2 * a))"


@register("qq_normal", f"""
    select z_father, child_id, son as sample, {norm_ppf_sql(_P)} as theoretical from (
        select z_father, child_id, son,
               row_number() over (partition by z_father order by son, child_id) as rn,
               count(*) over (partition by z_father) as n,
               case when count(*) over (partition by z_father) <= 10 then 0.375 else 0.5 end as a
        from (select child_id, son, round_even((father - avg(father) over ())
                                               / stddev_samp(father) over (), 0) as z_father
              from galton)
        where z_father between -2 and 2)""", "z_father sample theoretical", GALTON_CTE)
def q_qq_normal(spark, d):
    z = scale.zscore(galton(spark, d), "father", out="_z")
    z = z.withColumn("z_father", rnd("_z", 0)).filter(F.col("z_father").between(-2, 2))
    return binning.qq_normal(z, "son", "child_id", ["z_father"]).select(
        "z_father", "child_id", "sample", "theoretical")


_ctes = ols_sql_ctes("fb", STRATA_SQL, "R", ["BB"], ["HR_strata"])
_b0, _ = ols_sql_intercept(1)


@register("smooth_lm", f"""
    select g.HR_strata, g._i, g.BB, ({_b0}) + a_0_1 * g.BB as fitted,
           sqrt(s2 * (1.0 / n + (g.BB - m_0) * (g.BB - m_0) * a_0_0)) as se_fit
    from (select HR_strata, cast(t.i as integer) as _i, lo + (hi - lo) * t.i / 79.0 as BB
          from (select HR_strata, min(BB) as lo, max(BB) as hi from {STRATA_SQL} group by 1),
               range(80) t(i)) g
    join fb_fit using (HR_strata)""", "HR_strata BB fitted se_fit", _ctes)
def q_smooth_lm(spark, d):
    return binning.smooth_lm(hr_strata(spark, d), "BB", "R", ["HR_strata"], 80).select(
        "HR_strata", "_i", "BB", "fitted", "se_fit")


_ctes = {**ols_sql_ctes("fb", STRATA_SQL, "R", ["BB"], ["HR_strata"]), **t_crit_ctes("select distinct n - 2 as df from fb_fit")}


@register("smooth_band", f"""
    select HR_strata, _i, BB, fitted, se_fit, fitted - t_crit * se_fit as ymin, fitted + t_crit * se_fit as ymax from (
        select g.HR_strata, g._i, g.BB, ({_b0}) + a_0_1 * g.BB as fitted, n - 2 as df,
               sqrt(s2 * (1.0 / n + (g.BB - m_0) * (g.BB - m_0) * a_0_0)) as se_fit
        from (select HR_strata, cast(t.i as integer) as _i, lo + (hi - lo) * t.i / 79.0 as BB
              from (select HR_strata, min(BB) as lo, max(BB) as hi from {STRATA_SQL} group by 1), range(80) t(i)) g
        join fb_fit using (HR_strata)) left join crit using (df)""", "HR_strata BB fitted se_fit ymin ymax", _ctes)
def q_smooth_band(spark, d):
    """The fitted line with its 95% band per stratum."""
    return binning.smooth_lm(hr_strata(spark, d), "BB", "R", ["HR_strata"], 80)


@register("stack", """
    select major, gender, admission, number_of_students,
           sum(number_of_students) over (partition by major, gender order by admission
                                         rows between unbounded preceding and current row) as ymax,
           sum(number_of_students) over (partition by major, gender order by admission
                                         rows between unbounded preceding and current row)
             - number_of_students as ymin
    from (select major, gender, round_even(admitted / 100 * applicants, 0) as yes,
                 applicants - round_even(admitted / 100 * applicants, 0) as no from admissions)
    unpivot (number_of_students for admission in (yes, no))""",
    "number_of_students ymax ymin")
def q_stack(spark, d):
    a = admissions(spark, d)
    yes, no = yes_no("admitted", "applicants")
    long = gather(a.select("major", "gender", yes.alias("yes"), no.alias("no")),
                  ["major", "gender"], ["yes", "no"], "admission", "number_of_students")
    return binning.stack(long, ["major"], "gender", "admission", "number_of_students")
