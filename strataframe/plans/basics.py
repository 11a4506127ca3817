"""Registered queries for the data verbs: projections, filters, joins, aggregates,
reshaping, windows, dates and scalar functions (P, J, A, R, W, O, F, T families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions.columns import (
    agg_mean, agg_sd, agg_sum, normal_sql, remove_first, rnd, safe_corr, safe_div,
)
from strataframe.operators import aggs, resample, reshape, scale, verbs
from strataframe.operators.ols import slope_by
from strataframe.operators.ranks import avg_ranks, mad, positions
from strataframe.plans.registry import register
from strataframe.sources.fixtures import (
    admissions, appearances, award, batting, batting_year, children, events_xy, fielding,
    in_years, person, salary, team_season,
)
from strataframe.sources.tables import load, table

YEARS = (1996, 2000)


def galton(spark, d):
    """First-born sons: (child_id, family, father, son) — the height-pair table."""
    first = (children(spark, d).groupBy("family")
             .agg(F.min_by(F.struct("child_id", "father", "gender", "childHeight"), "child_id").alias("c")))
    return first.filter(F.col("c.gender") == "male").select(
        "c.child_id", "family", "c.father", F.col("c.childHeight").alias("son"))


GALTON_SQL = ("select child_id, family, father, childHeight as son from family "
              "where childNum = 1 and gender = 'male'")


# ---------------------------------------------------------------- projections / filters
@register("rates", """
    select teamID, yearID, HR / G as HR_per_game, R / G as R_per_game,
           SB / G as SB_per_game, BB / G as BB_per_game, AB / G as AB_per_game,
           W / G as win_rate, E / G as E_per_game, X2B / G as doubles_per_game,
           X3B / G as triples_per_game
    from team_season where yearID between 1996 and 2000""",
    "HR_per_game R_per_game SB_per_game BB_per_game AB_per_game win_rate E_per_game "
    "doubles_per_game triples_per_game")
def q_rates(spark, d):
    ts = team_season(spark, d, YEARS)
    pg = lambda c: safe_div(c, "G")
    return ts.select("teamID", "yearID", pg("HR").alias("HR_per_game"),
                     pg("R").alias("R_per_game"), pg("SB").alias("SB_per_game"),
                     pg("BB").alias("BB_per_game"), pg("AB").alias("AB_per_game"),
                     pg("W").alias("win_rate"), pg("E").alias("E_per_game"),
                     pg("X2B").alias("doubles_per_game"), pg("X3B").alias("triples_per_game"))


@register("mutate_overwrite", """
    select teamID, yearID, BB / G as BB, (H - X2B - X3B - HR) / G as singles,
           X2B / G as doubles, X3B / G as triples, HR / G as HR, R / G as R,
           round_even(HR / G, 1) as HR_strata
    from team_season where yearID between 1996 and 2000""",
    "BB singles doubles triples HR R HR_strata")
def q_mutate_overwrite(spark, d):
    ts = team_season(spark, d, YEARS)
    out = verbs.mutate(ts, [
        ("BB", safe_div("BB", "G")),
        ("singles", safe_div(F.col("H") - F.col("X2B") - F.col("X3B") - F.col("HR"), "G")),
        ("doubles", safe_div("X2B", "G")),
        ("triples", safe_div("X3B", "G")),
        ("HR", safe_div("HR", "G")),          # overwrites HR ...
        ("R", safe_div("R", "G")),
        ("HR_strata", rnd("HR", 1)),          # ... and this step sees the new HR
    ])
    return out.select("teamID", "yearID", "BB", "singles", "doubles", "triples", "HR", "R",
                      "HR_strata")


@register("filters", """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
           cast(l_tax > 0.04 as integer) as high_tax,
           case when l_quantity > 25 then 'big' else 'small' end as size
    from lineitem
    where year(l_shipdate) in (1997) and l_returnflag = 'R' and l_linestatus = 'F'
      and l_discount between 0.02 and 0.06 and round_even(l_quantity / 10, 0) = 3""",
    "l_quantity")
def q_filters(spark, d):
    li = load(spark, d, "lineitem")
    out = in_years(li, "l_shipdate", (1997, 1997)).filter(
                    (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
                    & F.col("l_discount").between(0.02, 0.06)
                    & (rnd(F.col("l_quantity") / 10, 0) == 3))
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      (F.col("l_tax") > 0.04).cast("int").alias("high_tax"),
                      F.when(F.col("l_quantity") > 25, "big").otherwise("small").alias("size"))


@register("select_forms", """
    select teamID, yearID, G, R as runs, HR, BB, SB from team_season""", "runs HR BB SB")
def q_select_forms(spark, d):
    ts = team_season(spark, d)
    rng = verbs.cols(ts, first="G", last="SB")                 # a range of columns
    keys = verbs.cols(ts, positions=[0, 1])                     # by position
    out = ts.select(*keys, *rng).withColumnRenamed("R", "runs")
    return out.drop(*verbs.cols(out, except_=[*keys, "G", "runs", "HR", "BB", "SB"]))


@register("filter_group", """
    select playerID, yearID, stint, AB, H from batting
    qualify sum(AB) over (partition by playerID, yearID) >= 1000""")
def q_filter_group(spark, d):
    b = batting(spark, d)
    kept = verbs.filter_group(b, ["playerID", "yearID"], [F.sum("AB").alias("_ab")],
                              F.col("_ab") >= 1000)
    return kept.select("playerID", "yearID", "stint", "AB", "H")


@register("exclude_row", """
    select event_id, time, observed_distance from events_xy where event_id <> 23""",
    "time observed_distance")
def q_exclude_row(spark, d):
    return verbs.exclude_row(events_xy(spark, d), "event_id", 23).select(
        "event_id", "time", "observed_distance")


@register("scalar_ref", """
    select teamID, yearID, R - (select avg(R) from team_season) as R_centered
    from team_season""", "R_centered")
def q_scalar_ref(spark, d):
    ts = team_season(spark, d)
    mean_r = ts.agg(F.avg("R").alias("R_mean"))                 # 1 row
    return (verbs.with_scalar(ts, mean_r)
            .select("teamID", "yearID", (F.col("R") - F.col("R_mean")).alias("R_centered")))


@register("argmax_filter", """
    select teamID, yearID, R, BB, cast(W >= 20 as integer) as flag
    from team_season
    where teamID = (select arg_min(teamID, -r) from (
            select teamID, corr(BB / G, R / G) as r from team_season group by teamID))
      and cast(W >= 20 as integer) = 1""", "R BB")
def q_argmax_filter(spark, d):
    ts = team_season(spark, d)
    per = ts.groupBy("teamID").agg(safe_corr(safe_div("BB", "G"), safe_div("R", "G")).alias("r"))
    best = verbs.argmax_row(per, "teamID", "r")               # 1 row
    rows = ts.join(F.broadcast(best), "teamID", "left_semi")
    flagged = rows.withColumn("flag", (F.col("W") >= 20).cast("int"))
    return flagged.filter(F.col("flag") == 1).select("teamID", "yearID", "R", "BB", "flag")


# ---------------------------------------------------------------- joins
@register("left_join", """
    select p.playerID, p.nameFirst, p.debut, s.salary
    from person p left join salary s using (playerID)""", "salary")
def q_left_join(spark, d):
    return verbs.left_join(person(spark, d), salary(spark, d), ["playerID"]).select(
        "playerID", "nameFirst", "debut", "salary")


@register("right_join", """
    select b.playerID, s.salary, b.AB, b.H
    from salary s right join (select * from batting_year where yearID = 1997) b using (playerID)
    where s.salary is not null""", "salary")
def q_right_join(spark, d):
    players = batting_year(spark, d, (1997, 1997))
    j = verbs.right_join(salary(spark, d), players, ["playerID"])
    # a NULL-rejecting filter after the outer join: Catalyst plans an inner join
    return j.filter(F.col("salary").isNotNull()).select("playerID", "salary", "AB", "H")


@register("semi_join", """
    select playerID, nameFirst, nameLast from person
    where playerID in (select playerID from award)""")
def q_semi_join(spark, d):
    return verbs.semi_join(person(spark, d), award(spark, d), ["playerID"]).select(
        "playerID", "nameFirst", "nameLast")


@register("join_suffix", """
    select playerID, a.awardID, a.yearID as yearID_x, b.yearID as yearID_y, b.stint, b.AB
    from award a right join batting b using (playerID)""")
def q_join_suffix(spark, d):
    j = verbs.join_suffix(award(spark, d), batting(spark, d), ["playerID"], "right")
    return j.select("playerID", "awardID", "yearID_x", "yearID_y", "stint", "AB")


# ---------------------------------------------------------------- aggregates
@register("summary_stats", f"""
    select avg(father) as mean_father, stddev_samp(father) as sd_father,
           avg(son) as mean_son, stddev_samp(son) as sd_son, count(*) as n
    from ({GALTON_SQL})""", "mean_father sd_father mean_son sd_son")
def q_summary_stats(spark, d):
    g = galton(spark, d)
    return g.agg(agg_mean("father").alias("mean_father"), agg_sd("father").alias("sd_father"),
                 agg_mean("son").alias("mean_son"), agg_sd("son").alias("sd_son"),
                 F.count("*").alias("n"))


RATES_SQL = """(select teamID, yearID, BB / G as BB, (H - HR - X2B - X3B) / G as singles,
                       HR / G as HR, R / G as R, X2B / G as doubles, X3B / G as triples
                from team_season where yearID between 1996 and 2000)"""


def team_rates(spark, d):
    ts = team_season(spark, d, YEARS)
    return ts.select("teamID", "yearID", safe_div("BB", "G").alias("BB"),
                     safe_div(F.col("H") - F.col("HR") - F.col("X2B") - F.col("X3B"), "G")
                     .alias("singles"),
                     safe_div("HR", "G").alias("HR"), safe_div("R", "G").alias("R"),
                     safe_div("X2B", "G").alias("doubles"), safe_div("X3B", "G").alias("triples"))


@register("corr_all", f"""
    select corr(BB, HR) as cor_BB_HR, corr(singles, HR) as cor_singles_HR,
           corr(BB, singles) as cor_BB_singles from {RATES_SQL}""",
    "cor_BB_HR cor_singles_HR cor_BB_singles")
def q_corr_all(spark, d):
    r = team_rates(spark, d)
    return r.agg(safe_corr("BB", "HR").alias("cor_BB_HR"),
                 safe_corr("singles", "HR").alias("cor_singles_HR"),
                 safe_corr("BB", "singles").alias("cor_BB_singles"))


@register("corr_matrix", "\nunion all\n".join(
    f"select '{a}' as var1, '{b}' as var2, corr({a}, {b}) as r from {RATES_SQL}"
    for i, a in enumerate(["BB", "HR", "singles", "R"]) for b in ["BB", "HR", "singles", "R"][i + 1:]),
    "r")
def q_corr_matrix(spark, d):
    return aggs.corr_matrix(team_rates(spark, d), ["BB", "HR", "singles", "R"])


@register("ratio_of_sums", """
    select teamID, sum(AB + BB) / max(G) as pa_per_game, min(G) as min_G, max(G) as max_G
    from batting where yearID = 1997 group by teamID""", "pa_per_game")
def q_ratio_of_sums(spark, d):
    b = batting(spark, d, (1997, 1997))
    return b.groupBy("teamID").agg(
        safe_div(agg_sum(F.col("AB") + F.col("BB")), F.max("G")).alias("pa_per_game"),
        F.min("G").alias("min_G"), F.max("G").alias("max_G"))


def pa_per_game(spark, d, year=1997):
    """Mean over teams of (plate appearances / games): a 1-row table."""
    b = batting(spark, d, (year, year))
    per_team = b.groupBy("teamID").agg(
        safe_div(agg_sum(F.col("AB") + F.col("BB")), F.max("G")).alias("_ppg"))
    return per_team.agg(F.avg("_ppg").alias("pa_per_game"))


PPG_SQL = """(select avg(ppg) as pa_per_game from (
                 select teamID, sum(AB + BB) / max(G) as ppg from batting
                 where yearID = 1997 group by teamID))"""


@register("nested_agg", f"select pa_per_game from {PPG_SQL}", "pa_per_game")
def q_nested_agg(spark, d):
    return pa_per_game(spark, d)


def player_rates(spark, d, years=(1996, 1998), min_pa=3000):
    """Per-player rates scaled by team plate appearances per game (C1 without R_hat)."""
    b = batting(spark, d, years)
    b = b.withColumn("PA", F.col("BB") + F.col("AB"))
    raw = {"_pa": agg_sum("PA"), "_bb": agg_sum("BB"),
           "_singles": agg_sum(F.col("H") - F.col("X2B") - F.col("X3B") - F.col("HR")),
           "_doubles": agg_sum("X2B"), "_triples": agg_sum("X3B"), "_hr": agg_sum("HR"),
           "_h": agg_sum("H"), "_ab": agg_sum("AB")}
    b = verbs.with_scalar(b, pa_per_game(spark, d))
    raw["_ppg"] = F.max("pa_per_game")
    steps = [("G", safe_div("_pa", "_ppg")),  # from here on G, BB, HR and PA are the results, not the source's columns
             ("BB", safe_div("_bb", "G")), ("singles", safe_div("_singles", "G")),
             ("doubles", safe_div("_doubles", "G")), ("triples", safe_div("_triples", "G")),
             ("HR", safe_div("_hr", "G")), ("AVG", safe_div("_h", "_ab")),
             ("PA", F.col("_pa"))]
    out = aggs.summarize_seq(b, ["playerID"], raw, steps).filter(F.col("PA") >= min_pa)
    return out.select("playerID", "BB", "singles", "doubles", "triples", "HR", "AVG", "PA")


PLAYERS_SQL = f"""(select playerID, BB, singles, doubles, triples, HR, AVG, PA from (
    select playerID, _bb / G as BB, _singles / G as singles, _doubles / G as doubles,
           _triples / G as triples, _hr / G as HR, _h / _ab as AVG, PA
    from (select *, _pa / pa_per_game as G, cast(_pa as bigint) as PA from (
            select playerID, sum(BB + AB) as _pa, sum(BB) as _bb,
                   sum(H - X2B - X3B - HR) as _singles, sum(X2B) as _doubles,
                   sum(X3B) as _triples, sum(HR) as _hr, sum(H) as _h, sum(AB) as _ab
            from batting where yearID between 1996 and 1998 group by playerID), {PPG_SQL}))
    where PA >= 3000)"""


@register("summarize_seq", f"select * from {PLAYERS_SQL}",
          "BB singles doubles triples HR AVG")
def q_summarize_seq(spark, d):
    return player_rates(spark, d)


@register("counts", """
    select gender, count(*) as n, cast(sum(applicants) as bigint) as applicants
    from admissions group by gender""")
def q_counts(spark, d):
    return admissions(spark, d).groupBy("gender").agg(
        F.count("*").alias("n"), F.sum("applicants").alias("applicants"))


@register("proportion", """
    select yearID, avg(case when 2 * H > AB then 1 else 0 end) as share_high, count(*) as n
    from batting_year group by yearID""", "share_high")
def q_proportion(spark, d):
    by = batting_year(spark, d)
    return by.groupBy("yearID").agg(aggs.proportion(2 * F.col("H") > F.col("AB"))
                                    .alias("share_high"), F.count("*").alias("n"))


@register("weighted_mean", """
    select gender, round(sum(admitted * applicants) / sum(applicants), 1) as percentage,
           avg(admitted) as average
    from admissions group by gender""", "percentage average")
def q_weighted_mean(spark, d):
    a = admissions(spark, d)
    return a.groupBy("gender").agg(
        F.bround(aggs.weighted_mean("admitted", "applicants"), 1).alias("percentage"),
        F.avg("admitted").alias("average"))


@register("share", """
    select major, sum(admitted * applicants) / sum(applicants) as major_selectivity,
           sum(applicants * (case when gender = 'F' then 1 else 0 end)) / sum(applicants) * 100
             as percent_women_applicants
    from admissions group by major""", "major_selectivity percent_women_applicants")
def q_share(spark, d):
    a = admissions(spark, d)
    return a.groupBy("major").agg(
        aggs.weighted_mean("admitted", "applicants").alias("major_selectivity"),
        aggs.share(F.col("gender") == "F", "applicants").alias("percent_women_applicants"))


@register("yes_no", """
    select major, gender, round_even(admitted / 100 * applicants, 0) as yes,
           applicants - round_even(admitted / 100 * applicants, 0) as no
    from admissions""", "yes no")
def q_yes_no(spark, d):
    a = admissions(spark, d)
    yes, no = aggs.yes_no("admitted", "applicants")
    return a.select("major", "gender", yes.alias("yes"), no.alias("no"))


@register("median_mad", """
    select yearID, median(R / G) as median, 1.4826 * mad(R / G) as mad
    from team_season group by yearID""", "median mad")
def q_median_mad(spark, d):
    ts = team_season(spark, d).withColumn("rpg", safe_div("R", "G"))
    return mad(ts, "rpg", ["yearID"])


@register("robust_scale", f"""
    select teamID, yearID, (BB - mb) / ab as BB, (HR - mh) / ah as HR, (R - mr) / ar as R
    from {RATES_SQL} r,
         (select median(BB) as mb, 1.4826 * mad(BB) as ab, median(HR) as mh,
                 1.4826 * mad(HR) as ah, median(R) as mr, 1.4826 * mad(R) as ar
          from {RATES_SQL})""", "BB HR R")
def q_robust_scale(spark, d):
    r = team_rates(spark, d).select("teamID", "yearID", "BB", "HR", "R")
    return scale.robust_scale(r, ["BB", "HR", "R"])


@register("summarize_at", """
    select yearID, cast(sum(AB) as bigint) as AB, cast(sum(H) as bigint) as H,
           cast(sum(BB) as bigint) as BB, cast(sum(HR) as bigint) as HR
    from batting group by yearID""")
def q_summarize_at(spark, d):
    return aggs.summarize_at(batting(spark, d), ["yearID"], ["AB", "H", "BB", "HR"], agg_sum)


# The position column names of the analysed appearances table.
NINE_NAMES = ["G_p", "G_c", "G_1b", "G_2b", "G_3b", "G_ss", "G_lf", "G_cf", "G_rf"]
POSITION_NAMES = NINE_NAMES[:5]
ARGMAX_SQL = ("case " + " ".join(
    f"when G_{i + 1} = greatest(G_1, G_2, G_3, G_4, G_5) then '{n}'"
    for i, n in enumerate(POSITION_NAMES)) + " end")


@register("argmax_cols", f"select playerID, {ARGMAX_SQL} as POS from appearances")
def q_argmax_cols(spark, d):
    a = appearances(spark, d)
    return a.select("playerID", verbs.argmax_cols(
        ["G_1", "G_2", "G_3", "G_4", "G_5"], POSITION_NAMES).alias("POS"))


def modal_position(spark, d):
    a = appearances(spark, d)
    pos = verbs.argmax_cols(["G_1", "G_2", "G_3", "G_4", "G_5"], POSITION_NAMES)
    return (a.select("playerID", F.upper(remove_first(pos, "G_")).alias("POS"))
            .filter(F.col("POS") != "P"))


MODAL_SQL = f"""(select playerID, POS from (
    select playerID, upper(regexp_replace({ARGMAX_SQL}, 'G_', '')) as POS from appearances)
    where POS <> 'P')"""


@register("modal_category", f"select * from {MODAL_SQL}")
def q_modal_category(spark, d):
    return modal_position(spark, d)


@register("strata_mean", f"""
    select round_even(father, 0) as father_strata, avg(son) as son_conditional_avg,
           count(*) as n
    from ({GALTON_SQL}) group by 1""", "father_strata son_conditional_avg")
def q_strata_mean(spark, d):
    return aggs.conditional_mean(galton(spark, d), "father", "son", 0, "father_strata")


STRATA_SQL = """(select round_even(HR / G, 0) as HR_strata, BB / G as BB, R / G as R
                 from team_season where round_even(HR / G, 0) between 6 and 11)"""


def hr_strata(spark, d):
    ts = team_season(spark, d)
    s = aggs.strata(ts, safe_div("HR", "G"), "HR_strata", 0, 6, 11)
    return s.select("HR_strata", safe_div("BB", "G").alias("BB"), safe_div("R", "G").alias("R"))


@register("strata_slope", f"""
    select HR_strata, case when var_samp(R) > 0 then regr_slope(R, BB) end as slope
    from {STRATA_SQL} group by HR_strata""", "HR_strata slope")
def q_strata_slope(spark, d):
    return slope_by(hr_strata(spark, d), "BB", "R", ["HR_strata"])


# ---------------------------------------------------------------- reshape
@register("crosstab", """
    select o_orderpriority, cast(count_if(o_orderstatus = 'F') as bigint) as F,
           cast(count_if(o_orderstatus = 'O') as bigint) as O,
           cast(count_if(o_orderstatus = 'P') as bigint) as P
    from orders group by 1""")
def q_crosstab(spark, d):
    return aggs.crosstab(load(spark, d, "orders"), "o_orderpriority", "o_orderstatus",
                         ["F", "O", "P"])


@register("crosstab_long", """
    select o_orderpriority, o_orderstatus, count(*) as n from orders group by 1, 2""")
def q_crosstab_long(spark, d):
    return aggs.crosstab_long(load(spark, d, "orders"), "o_orderpriority", "o_orderstatus")


@register("literal_join", """
    select name, count(*) as n, sum(l_quantity) as quantity
    from lineitem join (values ('A', 'accepted'), ('R', 'returned')) v(flag, name) on l_returnflag = flag
    group by name""", "quantity")
def q_literal_join(spark, d):
    """A literal table of labels joined to the rows it names."""
    labels = table(spark, [("A", "accepted"), ("R", "returned")], "l_returnflag string, name string")
    named = verbs.join_suffix(load(spark, d, "lineitem").select("l_returnflag", "l_quantity"), labels, ["l_returnflag"])
    return named.groupBy("name").agg(F.count("*").alias("n"), agg_sum("l_quantity").alias("quantity"))


@register("sort_forms", """
    select 'asc' as how, teamID, yearID, R, row_number() over (order by R, teamID, yearID) - 1 as place from team_season
    union all
    select 'desc' as how, teamID, yearID, R, row_number() over (order by R desc, teamID desc, yearID desc) - 1 as place from team_season""", "R")
def q_sort_forms(spark, d):
    """Every row with its place in both orders (O1, O2); the places of one order mirror those of the other."""
    ts = team_season(spark, d).select("teamID", "yearID", "R")
    up = positions(ts, [], ["R", "teamID", "yearID"], out="place")
    down = verbs.with_scalar(up, ts.agg((F.count("*") - 1).alias("_last"))).withColumn("place", F.col("_last") - F.col("place"))
    forms = [t.select(F.lit(how).alias("how"), "teamID", "yearID", "R", "place") for how, t in (("asc", up), ("desc", down))]
    return verbs.sort_desc(verbs.append(*forms), "how", "place")


@register("noise", f"""
    select event_id, observed_distance + {normal_sql(11, 'event_id', "'noise'", mean=5.0, sd=2.0)} as v from events_xy""", "v")
def q_noise(spark, d):
    """Normal noise on a column, drawn for each row by its key."""
    e = resample.normal_vector(events_xy(spark, d), "event_id", 11, 5.0, 2.0, "noise")
    return e.select("event_id", (F.col("observed_distance") + F.col("noise")).alias("v"))


@register("spread_str", """
    select major, F, O, F - O as women_minus_men from (
        select major, max(case when gender = 'F' then admitted end) as F,
               max(case when gender = 'O' then admitted end) as O
        from admissions group by major)""", "F O women_minus_men")
def q_spread_str(spark, d):
    a = admissions(spark, d).select("major", "gender", "admitted")
    w = reshape.spread(a, ["major"], "gender", "admitted", ["F", "O"])
    return w.withColumn("women_minus_men", F.col("F") - F.col("O"))


@register("spread_int", """
    select playerID, max(case when yearID = 1996 then H / AB end) as "1996",
           max(case when yearID = 1997 then H / AB end) as "1997"
    from batting_year where yearID in (1996, 1997) group by playerID""", ["1996", "1997"])
def q_spread_int(spark, d):
    b = (batting_year(spark, d, (1996, 1997))
         .select("playerID", "yearID", safe_div("H", "AB").alias("AVG")))
    return reshape.spread(b, ["playerID"], "yearID", "AVG", [1996, 1997])


@register("gather_range", """
    select family, child_id, parent, parentHeight from family
    unpivot (parentHeight for parent in (father, mother))""", "parentHeight")
def q_gather_range(spark, d):
    f = children(spark, d).select("family", "child_id", "father", "mother", "gender")
    cols_ = verbs.cols(f, first="father", last="mother")
    return reshape.gather(f, ["family", "child_id"], cols_, "parent", "parentHeight")


@register("gather_except", """
    select major, gender, admission, number_of_students from (
        select major, gender, round_even(admitted / 100 * applicants, 0) as yes,
               applicants - round_even(admitted / 100 * applicants, 0) as no from admissions)
    unpivot (number_of_students for admission in (yes, no))""", "number_of_students")
def q_gather_except(spark, d):
    a = admissions(spark, d)
    yes, no = aggs.yes_no("admitted", "applicants")
    yn = a.select("major", "gender", yes.alias("yes"), no.alias("no"))
    rest = verbs.cols(yn, except_=["major", "gender"])
    return reshape.gather(yn, ["major", "gender"], rest, "admission", "number_of_students")


@register("unite", """
    select family, child_id, parent || '_' ||
           case when gender = 'female' then 'daughter' else 'son' end as pair, parentHeight
    from family unpivot (parentHeight for parent in (father, mother))""", "parentHeight")
def q_unite(spark, d):
    f = children(spark, d).select("family", "child_id", "gender", "father", "mother")
    long = reshape.gather(f, ["family", "child_id", "gender"], ["father", "mother"],
                          "parent", "parentHeight")
    long = long.withColumn("child", F.when(F.col("gender") == "female", "daughter")
                           .otherwise("son"))
    return reshape.unite(long, "pair", ["parent", "child"]).select(
        "family", "child_id", "pair", "parentHeight")


@register("append", """
    select teamID, yearID, W from team_season where yearID = 1996
    union all
    select teamID, yearID, W from team_season where yearID = 1997""")
def q_append(spark, d):
    season = lambda y: team_season(spark, d, (y, y)).select("teamID", "yearID", "W")
    return verbs.append(season(1996), season(1997))


# ---------------------------------------------------------------- windows / sort / top-n
@register("first_per_group", """
    select playerID, POS, G, stint from fielding
    qualify row_number() over (partition by playerID order by G desc, stint) = 1""")
def q_first_per_group(spark, d):
    return verbs.first_per_group(fielding(spark, d), ["playerID"], "G", "stint").select(
        "playerID", "POS", "G", "stint")


@register("label_first", """
    select playerID, yearID,
           case when yearID = min(yearID) over (partition by playerID) then 'rookie'
                else 'other' end as rookie,
           count(*) over (partition by playerID) as n_seasons
    from batting_year""")
def q_label_first(spark, d):
    b = batting_year(spark, d).select("playerID", "yearID")
    lab = verbs.label_extreme(b, ["playerID"], "yearID", "rookie", "rookie", "other")
    n = b.groupBy("playerID").agg(F.count("*").alias("n_seasons"))
    return lab.join(n, "playerID").select("playerID", "yearID", "rookie", "n_seasons")


@register("top_n_ties", """
    select teamID, yearID, W from team_season
    qualify rank() over (order by W desc) <= 10""")
def q_top_n_ties(spark, d):
    return verbs.top_n(team_season(spark, d).select("teamID", "yearID", "W"), 10, "W")


@register("sorts", """
    select teamID, yearID, R from team_season order by R desc, teamID asc limit 6""", "R")
def q_sorts(spark, d):
    ts = team_season(spark, d).select("teamID", "yearID", "R")
    return ts.orderBy(F.col("R").desc_nulls_last(), F.col("teamID").asc_nulls_last()).limit(6)


@register("zscore", f"""
    select child_id, son, z_father from (
        select child_id, son,
               round_even((father - avg(father) over ()) / stddev_samp(father) over (), 0)
                 as z_father
        from ({GALTON_SQL}))
    where z_father between -2 and 2""", "son z_father")
def q_zscore(spark, d):
    z = scale.zscore(galton(spark, d), "father", out="z")
    z = z.withColumn("z_father", rnd("z", 0)).filter(F.col("z_father").between(-2, 2))
    return z.select("child_id", "son", "z_father")


@register("zscore_where", """
    select event_id, case when event_id <> 23
        then (observed_distance - (select avg(observed_distance) from events_xy where event_id <> 23))
             / (select stddev_samp(observed_distance) from events_xy where event_id <> 23)
        else observed_distance end as z
    from events_xy""", "z")
def q_zscore_where(spark, d):
    e = events_xy(spark, d)
    z = scale.zscore(e, "observed_distance", out="z", where=F.col("event_id") != 23)
    return z.select("event_id", "z")


@register("share_of_total", """
    select major, gender, admitted * applicants / sum(applicants) over () as percent_admitted
    from admissions""", "percent_admitted")
def q_share_of_total(spark, d):
    a = admissions(spark, d)
    s = scale.share_of_total(a, F.col("applicants").cast("double"), "_w")
    return s.select("major", "gender", (F.col("admitted") * F.col("_w")).alias("percent_admitted"))


@register("avg_rank", """
    select event_id,
           rank() over (order by observed_distance)
             + (count(*) over (partition by observed_distance) - 1) / 2.0 as rank_all,
           rank() over (partition by "group" order by observed_distance)
             + (count(*) over (partition by "group", observed_distance) - 1) / 2.0
             as rank_in_group
    from events_xy""", "rank_all rank_in_group")
def q_avg_rank(spark, d):
    e = events_xy(spark, d).select("event_id", "group", "observed_distance")
    r = avg_ranks(e, [("observed_distance", [], "rank_all"), ("observed_distance", ["group"], "rank_in_group")])
    return r.select("event_id", "rank_all", "rank_in_group")


# ---------------------------------------------------------------- dates / scalars
@register("dates", """
    select playerID, cast(debut as date) as debut, cast(year(cast(debut as date)) as integer)
           as debut_year
    from person
    where year(cast(debut as date)) < 1998
      and cast(debut as date) <= date '1997-01-01' and cast(debut as date) > date '1995-06-01'""")
def q_dates(spark, d):
    p = person(spark, d).withColumn("debut", F.try_to_date("debut"))
    p = p.filter((F.year("debut") < 1998) & (F.col("debut") <= F.lit("1997-01-01").cast("date"))
                 & (F.col("debut") > F.lit("1995-06-01").cast("date")))
    return p.select("playerID", "debut", F.year("debut").alias("debut_year"))


@register("scalars", """
    select teamID, yearID, (R / G) * (R / G) as R_sq, power(R / G, 3) as R_cube,
           sqrt(R) as R_sqrt,
           log10(R) as log_R, cast(round_even(HR / G, 0) as integer) as HR_strata
    from team_season""", "R_sq R_cube R_sqrt log_R")
def q_scalars(spark, d):
    ts = team_season(spark, d)
    rpg = safe_div("R", "G")
    return ts.select("teamID", "yearID", (rpg * rpg).alias("R_sq"),
                     F.pow(safe_div("R", "G"), 3).alias("R_cube"), F.sqrt("R").alias("R_sqrt"),
                     F.log10("R").alias("log_R"),
                     rnd(safe_div("HR", "G"), 0).cast("int").alias("HR_strata"))


@register("indicator", """
    select major, gender, applicants * (case when gender = 'F' then 1 else 0 end) as women
    from admissions""")
def q_indicator(spark, d):
    a = admissions(spark, d)
    return a.select("major", "gender", (F.col("applicants") * F.when(
        F.col("gender") == "F", 1).otherwise(0)).alias("women"))


@register("scatter_pairs", f"""
    select child_id, father, son,
           (father - avg(father) over ()) / stddev_samp(father) over () as father_z,
           (son - avg(son) over ()) / stddev_samp(son) over () as son_z
    from ({GALTON_SQL})""", "father son father_z son_z")
def q_scatter_pairs(spark, d):
    g = scale.zscore(scale.zscore(galton(spark, d), "father", out="father_z"), "son",
                     out="son_z")
    return g.select("child_id", "father", "son", "father_z", "son_z")


__all__ = ["galton", "team_rates", "hr_strata", "player_rates", "modal_position",
           "pa_per_game"]


_NINE = ", ".join(f"count_if(o_orderkey % 9 = {i}) as g{i}" for i in range(9))
_NINE_CASE = "case " + " ".join(f"when g{i} = greatest({', '.join(f'g{j}' for j in range(9))}) then '{n}'" for i, n in enumerate(NINE_NAMES)) + " end"


@register("argmax_nine", f"""
    select playerID, {_NINE_CASE} as POS from (select o_custkey as playerID, {_NINE} from orders group by 1)""")
def q_argmax_nine(spark, d):
    """The most frequent of all nine positions, the first one on ties."""
    counts = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("playerID")).agg(
        *[F.count_if(F.col("o_orderkey") % 9 == i).alias(n) for i, n in enumerate(NINE_NAMES)])
    return counts.select("playerID", verbs.argmax_cols(NINE_NAMES).alias("POS"))
