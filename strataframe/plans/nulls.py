"""Registered queries on inputs with derived NULLs: NULL keys as groups, strict and skipping
aggregates, joins on NULL keys; and the studies that combine several operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions.columns import agg_mean, agg_sd, norm_ppf_sql, rnd, safe_corr, uniform_sql
from strataframe.operators import aggs, binning, infer, ranks, resample, reshape, scale, verbs
from strataframe.operators.ols import line, ols
from strataframe.plans.basics import galton
from strataframe.plans.models import GALTON_CTE, rates_sql, team_rates_all
from strataframe.plans.registry import ols_sql_ctes, ols_sql_intercept, register
from strataframe.plans.sampling import SEED_FAMILY
from strataframe.sources.fixtures import children, events_xy, person, salary
from strataframe.sources.tables import load

#: The event type whose rows get a NULL key, and every so many values that are NULL.
NO_KEY, NO_VALUE = "click", 11

KEYED_SQL = f"""(select event_id, nullif(event_type, '{NO_KEY}') as kind, time, observed_distance as v from events_xy)"""
HOLES_SQL = f"""(select event_id, nullif(event_type, '{NO_KEY}') as kind, "group" as w,
    case when event_id % {NO_VALUE} <> 0 or event_type = 'view' then observed_distance end as v from events_xy)"""


def keyed(spark, d):
    """Events by kind, with one kind NULL."""
    e = events_xy(spark, d)
    return e.select("event_id", F.nullif(F.col("event_type"), F.lit(NO_KEY)).alias("kind"), "time",
                    F.col("observed_distance").alias("v"))


def holes(spark, d):
    """Events by kind, with one kind NULL and NULL values in all kinds but 'view'."""
    e = events_xy(spark, d)
    value = F.when((F.col("event_id") % NO_VALUE != 0) | (F.col("event_type") == "view"), F.col("observed_distance"))
    return e.select("event_id", F.nullif(F.col("event_type"), F.lit(NO_KEY)).alias("kind"), F.col("group").alias("w"),
                    value.alias("v"))


# ---------------------------------------------------------------- NULL keys
@register("scale_by", f"""
    select event_id, kind, (v - avg(v) over p) / stddev_samp(v) over p as z, v / sum(v) over p as share
    from {KEYED_SQL} window p as (partition by kind)""", "z share")
def q_scale_by(spark, d):
    z = scale.zscore(keyed(spark, d), "v", ["kind"], "z")
    return scale.share_of_total(z, "v", "share", ["kind"]).select("event_id", "kind", "z", "share")


@register("robust_by", f"""
    select event_id, k.kind, (v - m) / (1.4826 * a) as v from {KEYED_SQL} k join (
        select kind, median(v) as m, mad(v) as a from {KEYED_SQL} group by kind) s
    on k.kind is not distinct from s.kind""", "v")
def q_robust_by(spark, d):
    return scale.robust_scale(keyed(spark, d), ["v"], ["kind"]).select("event_id", "kind", "v")


@register("rank_by", f"""
    select event_id, kind, rank() over (partition by kind order by v)
        + (count(*) over (partition by kind, v) - 1) / 2.0 as r from {KEYED_SQL}""", "r")
def q_rank_by(spark, d):
    return ranks.avg_rank(keyed(spark, d), "v", ["kind"], "r").select("event_id", "kind", "r")


@register("spearman_by", f"""
    select kind, corr(rx, ry) as spearman, corr(time, v) as pearson from (
        select kind, time, v, rank() over (partition by kind order by time)
                 + (count(*) over (partition by kind, time) - 1) / 2.0 as rx,
               rank() over (partition by kind order by v) + (count(*) over (partition by kind, v) - 1) / 2.0 as ry
        from {KEYED_SQL}) group by kind""", "spearman pearson")
def q_spearman_by(spark, d):
    return infer.spearman(keyed(spark, d), "time", "v", ["kind"])


@register("filter_label_by", f"""
    select event_id, kind, case when v = min(v) over (partition by kind) then 'least' else 'other' end as label
    from {KEYED_SQL} qualify count(*) over (partition by kind) > 100""")
def q_filter_label_by(spark, d):
    big = verbs.filter_group(keyed(spark, d), ["kind"], [F.count("*").alias("_n")], F.col("_n") > 100)
    return verbs.label_extreme(big, ["kind"], "v", "label", "least", "other").select("event_id", "kind", "label")


@register("top_by", f"""
    select event_id, kind, v from {KEYED_SQL} qualify rank() over (partition by kind order by v desc) <= 5""", "v")
def q_top_by(spark, d):
    return verbs.top_n(keyed(spark, d), 5, "v", ["kind"]).select("event_id", "kind", "v")


@register("histogram_by", f"""
    with c as (select kind, cast(ceil(v / 25.0 - 0.5) as bigint) as bin, count(*) as count from {KEYED_SQL} group by 1, 2),
         s as (select kind, unnest(generate_series(min(bin), max(bin))) as bin from c group by kind)
    select s.kind, s.bin, s.bin * 25.0 as x, (s.bin - 0.5) * 25.0 as xmin, (s.bin + 0.5) * 25.0 as xmax,
           coalesce(c.count, 0) as count
    from s left join c on s.bin = c.bin and s.kind is not distinct from c.kind""", "x xmin xmax")
def q_histogram_by(spark, d):
    return binning.histogram(keyed(spark, d), "v", 25.0, ["kind"])


@register("boxplot_by", f"""
    with q as (select kind, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3
               from {KEYED_SQL} group by kind),
         r as (select q.*, k.v, k.v between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) as inside
               from {KEYED_SQL} k join q on k.kind is not distinct from q.kind)
    select kind, q1, median, q3, min(v) filter (inside) as ymin, max(v) filter (inside) as ymax,
           cast(count_if(not inside) as bigint) as n_outliers, count(*) as n
    from r group by all""", "q1 median q3 ymin ymax")
def q_boxplot_by(spark, d):
    return binning.boxplot(keyed(spark, d), "v", ["kind"])


_P = "((rn - 0.5) / n)"


@register("qq_by", f"""
    select kind, event_id, v as sample, {norm_ppf_sql(_P)} as theoretical from (
        select *, row_number() over (partition by kind order by v, event_id) as rn, count(*) over (partition by kind) as n
        from {KEYED_SQL})""", "sample theoretical")
def q_qq_by(spark, d):
    return binning.qq_normal(keyed(spark, d), "v", "event_id", ["kind"])


@register("skyline_by", f"""
    select event_id, kind, time, v from {KEYED_SQL} k where not exists (
        select 1 from {KEYED_SQL} o where o.kind is not distinct from k.kind and o.time <= k.time and o.v >= k.v
          and (o.time < k.time or o.v > k.v))""", "time v")
def q_skyline_by(spark, d):
    return verbs.skyline(keyed(spark, d), ["kind"], "time", "v").select("event_id", "kind", "time", "v")


_ctes = ols_sql_ctes("fk", KEYED_SQL, "v", ["time"], ["kind"])
_b0, _ = ols_sql_intercept(1)


@register("predict_by", f"""
    select event_id, k.kind, ({_b0}) + a_0_1 * time as fitted,
           sqrt(s2) * sqrt(1.0 / n + (time - m_0) * (time - m_0) * a_0_0) as se_fit,
           cast(n - 2 as bigint) as df, sqrt(s2) as residual_scale
    from {KEYED_SQL} k join fk_fit f on k.kind is not distinct from f.kind""", "fitted se_fit residual_scale", _ctes)
def q_predict_by(spark, d):
    k = keyed(spark, d)
    return ols(k, "v", ["time"], ["kind"]).predict(k, se=True).select(
        "event_id", "kind", "fitted", "se_fit", "df", "residual_scale")


@register("line_by", f"""
    select kind, avg(time) as mu_x, avg(v) as mu_y, corr(time, v) as r,
           corr(time, v) * stddev_samp(v) / stddev_samp(time) as slope from {KEYED_SQL} group by kind""",
          "mu_x mu_y r slope")
def q_line_by(spark, d):
    return line(keyed(spark, d), "time", "v", ["kind"]).select("kind", "mu_x", "mu_y", "r", "slope")


@register("corr_matrix_by", f"""
    select kind, 'time' as var1, 'v' as var2, corr(time, v) as r from {KEYED_SQL} group by kind""", "r")
def q_corr_matrix_by(spark, d):
    return aggs.corr_matrix(keyed(spark, d), ["time", "v"], ["kind"])


# ---------------------------------------------------------------- NULL values
HOLES_KEYED_SQL = f"""(select case when event_id % {NO_VALUE} = 0 then 'holes' else 'whole' end as kind, time,
    case when event_id % {NO_VALUE} <> 0 then observed_distance end as v from events_xy)"""


@register("corr_excl_nulls", f"""
    select 'no such key' as what, corr(time, observed_distance) as r_all, corr(time, observed_distance) as r_without from events_xy
    union all
    select 'a key', corr(time, observed_distance), corr(time, observed_distance) filter (where event_type not in ('view') or event_type = '{NO_KEY}') from events_xy
    union all
    select 'NULL values', null, null from events_xy having count(*) > 0
    union all
    select 'NULLs left out', null, corr(time, v) from {HOLES_KEYED_SQL} where kind <> 'holes'""", "r_all r_without")
def q_corr_excl_nulls(spark, d):
    """Correlation without a key's rows where keys or values are NULL (M22): rows without a key stay, NULLs among the
    rows that are left give NULL, NULLs among the excluded rows do not."""
    e = events_xy(spark, d)
    kind = F.nullif(F.col("event_type"), F.lit(NO_KEY)).alias("kind")
    plain = e.select(kind, "time", F.col("observed_distance").alias("v"))
    some = e.select(kind, "time", F.when(F.col("event_id") % NO_VALUE != 0, F.col("observed_distance")).alias("v"))
    odd = e.select(F.when(F.col("event_id") % NO_VALUE == 0, "holes").otherwise("whole").alias("kind"), "time",
                   F.when(F.col("event_id") % NO_VALUE != 0, F.col("observed_distance")).alias("v"))
    parts = {"no such key": (plain, "none"), "a key": (plain, "view"), "NULL values": (some, "view"), "NULLs left out": (odd, "holes")}
    out = [infer.corr_excluding(t, "time", "v", "kind", k).select(F.lit(what).alias("what"), "r_all", "r_without") for what, (t, k) in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@register("smooth_nulls", f"""
    select kind, _i, lo + (hi - lo) * _i / 79.0 as w from (
        select kind, min(w) as lo, max(w) as hi from {HOLES_SQL} where v is not null group by kind), (select cast(range as integer) as _i from range(80))""", "w")
def q_smooth_nulls(spark, d):
    """The grid of a fitted line spans the rows that have a response (V4)."""
    return binning.smooth_lm(holes(spark, d).withColumn("w", F.col("w").cast("double")), "w", "v", ["kind"]).select("kind", "_i", "w")


@register("argmax_types", """
    select arg_max(o_orderkey, struct_pack(a := o_orderdate, b := -o_orderkey)) as by_date,
           arg_max(o_orderkey, struct_pack(a := o_orderpriority, b := -o_orderkey)) as by_text from orders""")
def q_argmax_types(spark, d):
    """The row with the latest date and the one with the greatest text, ties to the smallest key."""
    o = load(spark, d, "orders")
    first, last = (verbs.argmax_row(o, "o_orderkey", c) for c in ("o_orderdate", "o_orderpriority"))
    return verbs.with_scalar(first.withColumnRenamed("o_orderkey", "by_date"), last.withColumnRenamed("o_orderkey", "by_text"))


@register("strict_nulls", f"""
    select kind, case when count(v) = count(*) then avg(v) end as mean, case when count(v) = count(*) then median(v) end as median,
           case when count(v) = count(*) then sum(v * w) / sum(w) end as wmean,
           sum(v * w) / sum(case when v is not null then w end) as wmean_known,
           case when count(v) = count(*) then 100.0 * sum(case when v > 20 then w else 0 end) / sum(w) end as share,
           100.0 * sum(case when v > 20 then w else 0 end) / sum(case when v is not null then w end) as share_known,
           avg(v) as mean_known, median(v) as median_known, stddev_samp(v) as sd_known
    from {HOLES_SQL} group by kind""", "mean median wmean wmean_known share share_known mean_known median_known sd_known")
def q_strict_nulls(spark, d):
    h = holes(spark, d)
    big = F.col("v") > 20
    m = h.groupBy("kind").agg(
        agg_mean("v").alias("mean"), aggs.weighted_mean("v", "w").alias("wmean"),
        aggs.weighted_mean("v", "w", skip_nulls=True).alias("wmean_known"), aggs.share(big, "w").alias("share"),
        aggs.share(big, "w", skip_nulls=True).alias("share_known"), agg_mean("v", skip_nulls=True).alias("mean_known"),
        agg_sd("v", skip_nulls=True).alias("sd_known"))
    m = verbs.left_join(m, ranks.median(h, "v", ["kind"]), ["kind"])
    return verbs.left_join(m, ranks.median(h, "v", ["kind"], "median_known", skip_nulls=True), ["kind"])


@register("first_with_nulls", f"""
    select event_id, kind, v from {HOLES_SQL} qualify row_number() over (partition by kind, w order by v desc nulls last, event_id) = 1""", "v")
def q_first_with_nulls(spark, d):
    return verbs.first_per_group(holes(spark, d), ["kind", "w"], "v", "event_id").select("event_id", "kind", "v")


_LEFT = "(select nullif(playerID % 50, 7) as k, playerID as a from person)"
_RIGHT = "(select nullif(playerID % 50 + 10, 17) as k, sum(salary) as b from salary group by 1)"


@register("joins_null", f"""
    select 'left' as how, l.k, l.a, r.b from {_LEFT} l left join {_RIGHT} r on l.k is not distinct from r.k
    union all select 'right', r.k, l.a, r.b from {_LEFT} l right join {_RIGHT} r on l.k is not distinct from r.k
    union all select 'inner', l.k, l.a, r.b from {_LEFT} l join {_RIGHT} r on l.k is not distinct from r.k
    union all select 'sql', l.k, l.a, r.b from {_LEFT} l join {_RIGHT} r on l.k = r.k""", "b")
def q_joins_null(spark, d):
    """Joins of whole tables on a key that is NULL in both: R matches them, SQL does not (J1–J3). Either side has
    keys that the other lacks."""
    key = F.col("playerID") % 50
    left = person(spark, d).select(F.nullif(key, F.lit(7)).alias("k"), F.col("playerID").alias("a"))
    right = salary(spark, d).groupBy(F.nullif(key + 10, F.lit(17)).alias("k")).agg(F.sum("salary").alias("b"))
    tables = {"left": verbs.left_join(left, right, ["k"]), "right": verbs.right_join(left, right, ["k"]),
              "inner": verbs.join_suffix(left, right, ["k"]), "sql": verbs.join_suffix(left, right, ["k"], null_matches=False)}
    out = [t.select(F.lit(how).alias("how"), "k", "a", "b") for how, t in tables.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


# ---------------------------------------------------------------- studies
DAUGHTERS_SQL = f"""(select family, mother, childHeight as daughter from family where gender = 'female'
    qualify row_number() over (partition by family order by {uniform_sql(SEED_FAMILY, 'child_id')}) = 1)"""


@register("mother_daughter", f"""
    select mu_x, mu_y, s_x, s_y, r, r * s_y / s_x as slope, mu_y - r * s_y / s_x * mu_x as intercept,
           mu_y + r * s_y / s_x * (60 - mu_x) as pred_60
    from (select avg(mother) as mu_x, avg(daughter) as mu_y, stddev_samp(mother) as s_x, stddev_samp(daughter) as s_y,
                 corr(mother, daughter) as r from {DAUGHTERS_SQL})""", "mu_x mu_y s_x s_y r slope intercept pred_60")
def q_mother_daughter(spark, d):
    """One daughter per family, the regression line on her mother's height, and its value at 60."""
    girls = children(spark, d).filter(F.col("gender") == "female")
    one = resample.sample_per_group(girls, ["family"], SEED_FAMILY, "child_id").withColumnRenamed("childHeight", "daughter")
    return line(one, "mother", "daughter").withColumn("pred_60", F.col("intercept") + F.col("slope") * 60)


@register("conditional_mean_at", """
    select avg(son) as son_at_65, count(*) as n from galton where round_even(father, 0) = 65""", "son_at_65", GALTON_CTE)
def q_conditional_mean_at(spark, d):
    """Mean of the sons whose father's height rounds to 65."""
    at = galton(spark, d).filter(rnd("father", 0) == 65)
    return at.agg(agg_mean("son").alias("son_at_65"), F.count("*").alias("n"))


PAIR_SQL = f"""(select parent || '_' || case when gender = 'female' then 'daughter' else 'son' end as pair, parentHeight, childHeight
    from (select family, gender, child_id, father, mother, childHeight from family
          qualify row_number() over (partition by family, gender order by {uniform_sql(SEED_FAMILY, 'child_id')}) = 1)
    unpivot (parentHeight for parent in (father, mother)))"""


@register("pair_study", f"""
    select pair, count(*) as n, corr(parentHeight, childHeight) as r, regr_slope(childHeight, parentHeight) as slope
    from {PAIR_SQL} group by pair""", "r slope")
def q_pair_study(spark, d):
    """One child of each sex per family, gathered by parent: count, correlation and slope of each pair."""
    one = resample.sample_per_group(children(spark, d), ["family", "gender"], SEED_FAMILY, "child_id")
    long = reshape.gather(one.select("family", "gender", "childHeight", "father", "mother"),
                          ["family", "gender", "childHeight"], ["father", "mother"], "parent", "parentHeight")
    long = long.withColumn("child", F.when(F.col("gender") == "female", "daughter").otherwise("son"))
    pairs = reshape.unite(long, "pair", ["parent", "child"])
    fits = ols(pairs, "childHeight", ["parentHeight"], ["pair"]).coef("parentHeight", p_values=False)
    r = pairs.groupBy("pair").agg(F.count("*").alias("n"), safe_corr("parentHeight", "childHeight").alias("r"))
    return verbs.left_join(r, fits.select("pair", F.col("estimate").alias("slope")), ["pair"])


@register("sample_two_per_group", f"""
    select family, child_id from family qualify row_number() over (
        partition by family order by {uniform_sql(SEED_FAMILY, 'child_id')}, child_id) <= 2""")
def q_sample_two(spark, d):
    return resample.sample_per_group(children(spark, d), ["family"], SEED_FAMILY, "child_id", 2).select("family", "child_id")


EXTREME_SQL = """(select "group", corr(time, observed_distance) as r from events_xy group by "group")"""


@register("extreme_events", f"""
    select e."group", max(x.r) as r, regr_slope(observed_distance, time) as slope,
           regr_intercept(observed_distance, time) as intercept
    from events_xy e join (select * from {EXTREME_SQL} order by r desc, "group" limit 1) x using ("group")
    group by e."group\"""", "r slope intercept")
def q_extreme_events(spark, d):
    """The user whose events correlate most with time, and the line through them."""
    e = events_xy(spark, d)
    fit = infer.extreme_group_fit(e, "group", "time", "observed_distance")
    best = infer.extreme_group(e, "group", "time", "observed_distance")
    lines = fit.fit_df.select("group", F.col("coef")[1].alias("slope"), F.col("coef")[0].alias("intercept"))
    return verbs.join_suffix(best, lines, ["group"])


_ctes5 = ols_sql_ctes("fw", rates_sql("where yearID between 1995 and 1999"), "R", ["BB", "HR"])
_b2, _ = ols_sql_intercept(2)


@register("predict_se", f"""
    select r.teamID, ({_b2}) + a_0_2 * r.BB + a_1_2 * r.HR as fitted,
           sqrt(s2) * sqrt(1.0 / n + (r.BB - m_0) * (r.BB - m_0) * a_0_0 + 2 * (r.BB - m_0) * (r.HR - m_1) * a_0_1
                           + (r.HR - m_1) * (r.HR - m_1) * a_1_1) as se_fit,
           cast(n - 3 as bigint) as df, sqrt(s2) as residual_scale
    from {rates_sql('where yearID = 2000')} r, fw_fit""", "fitted se_fit residual_scale", _ctes5)
def q_predict_se(spark, d):
    fit = ols(team_rates_all(spark, d, (1995, 1999)), "R", ["BB", "HR"])
    return fit.predict(team_rates_all(spark, d, (2000, 2000)), se=True).select(
        "teamID", "fitted", "se_fit", "df", "residual_scale")
