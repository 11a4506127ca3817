"""Registered queries of user functions folded over groups, losses over parameter grids, wide correlation matrices,
mergeable quantile sketches and joins with heavy keys."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from strataframe.operators import fold, heavy, sketch
from strataframe.plans.basics import GALTON_SQL, galton
from strataframe.plans.nulls import KEYED_SQL, keyed
from strataframe.plans.registry import register
from strataframe.sources.fixtures import events_xy
from strataframe.sources.tables import load


def line_state(values):
    """State of a straight line: rows, means, centred sums of squares and products."""
    x, y = values["time"], values["v"]
    dx, dy = x - x.mean(), y - y.mean()
    return np.array([len(x), x.mean(), y.mean(), dx @ dx, dx @ dy])


def merge_lines(a, b):
    n, dx, dy = a[0] + b[0], b[1] - a[1], b[2] - a[2]
    w = a[0] * b[0] / n
    return np.array([n, a[1] + dx * b[0] / n, a[2] + dy * b[0] / n, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dx * dy * w])


def finish_line(state):
    """Two rows: intercept and slope."""
    _, mx, my, sxx, sxy = state
    if not sxx > 0:
        return [("(Intercept)", None), ("time", None)]
    return [("(Intercept)", float(my - sxy / sxx * mx)), ("time", float(sxy / sxx))]


@register("per_group_fold", f"""
    select kind, '(Intercept)' as term, regr_intercept(v, time) as estimate from {KEYED_SQL} group by kind
    union all select kind, 'time', regr_slope(v, time) from {KEYED_SQL} group by kind""", "estimate")
def q_per_group_fold(spark, d):
    """A user function with several result rows per group, as partial, merge and finish: a large group is split."""
    return fold.fold_groups(keyed(spark, d), ["kind"], ["time", "v"], line_state, merge_lines, finish_line, "term string, estimate double")


POINTS, BETA_0 = 198, 25.0


@register("abs_loss_grid", f"""
    select i, i / {POINTS - 1.0!r} as grid, sum(abs(son - ({BETA_0!r} + i / {POINTS - 1.0!r} * father))) as loss
    from galton, (select range as i from range({POINTS})) group by i""", "grid loss", {"galton": GALTON_SQL})
def q_abs_loss_grid(spark, d):
    """Absolute error of a line for each of its slopes on a grid: no closed form."""
    grid = [i / (POINTS - 1.0) for i in range(POINTS)]
    return fold.grid_sums(galton(spark, d), ["father", "son"], grid, lambda t, b: np.abs(t["son"] - (BETA_0 + b * t["father"])))


WIDE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(WIDE) for b in WIDE[i + 1:]]


@register("corr_matrix_wide", " union all ".join(
    f"select l_returnflag, '{a}' as var1, '{b}' as var2, corr({a}, {b}) as r from lineitem group by l_returnflag" for a, b in _PAIRS), "r")
def q_corr_matrix_wide(spark, d):
    """All correlations of eight columns per flag, from blocks of centred cross products (A4)."""
    return fold.corr_matrix_wide(load(spark, d, "lineitem"), WIDE, ["l_returnflag"])


PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


@register("sketch_quantiles", f"""
    select event_type, prob, true as within from (select distinct event_type from events), (select unnest([{', '.join(map(str, PROBS))}]) as prob)""", "prob")
def q_sketch_quantiles(spark, d):
    """Sketches per user and type, merged per type: is the rank of every answer as near as the sketch's bound says?"""
    e = events_xy(spark, d)
    fine = sketch.quantile_sketches(e, "observed_distance", ["event_type", "group"])
    asked = sketch.sketch_quantiles(sketch.merged_sketches(fine, ["event_type"]), PROBS, ["event_type"])
    ranks = e.join(asked, "event_type").groupBy("event_type", "prob").agg(
        F.avg((F.col("observed_distance") < F.col("value")).cast("int")).alias("low"),
        F.avg((F.col("observed_distance") <= F.col("value")).cast("int")).alias("high"))
    bound = 2 * sketch.rank_error()  # several answers, each at 99 % within half of it
    return ranks.select("event_type", "prob", ((F.col("low") <= F.col("prob") + bound) & (F.col("high") >= F.col("prob") - bound)).alias("within"))


@register("join_heavy", """
    select l_returnflag as flag, l_linestatus as status, count(*) as n, sum(l_quantity) as quantity, max(share) as share
    from lineitem left join (select l_returnflag as flag, count(*) / (select count(*) from lineitem) as share
                             from lineitem where l_returnflag <> 'A' group by 1) s on l_returnflag = s.flag
    group by 1, 2""", "quantity share")
def q_join_heavy(spark, d):
    """A left join in which every key is heavy, summed up."""
    li = load(spark, d, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), "l_quantity")
    n = li.agg(F.count("*").alias("_all"))
    from strataframe.operators.attach import attach_row

    shares = attach_row(li.filter(F.col("flag") != "A").groupBy("flag").agg(F.count("*").alias("c")), n)
    shares = shares.select("flag", (F.col("c") / F.col("_all")).alias("share"))
    joined = heavy.join_heavy(li, shares, ["flag"], "left")
    return joined.groupBy("flag", "status").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"), F.max("share").alias("share"))
