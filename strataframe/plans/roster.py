"""Registered composite queries: scoring entities with a team-level model, attaching price,
category and names, non-dominated candidates, robust profiles, and the first-vs-second
season and two-season comparisons (C1–C8, V9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataframe.functions.columns import safe_div
from strataframe.operators import reshape, scale, verbs
from strataframe.operators.ols import ols
from strataframe.plans.basics import MODAL_SQL, PLAYERS_SQL, modal_position, player_rates
from strataframe.plans.models import FIVE, PAIRED_SQL, qualified_avg, rates_sql, team_rates_all
from strataframe.plans.registry import ols_sql_ctes, ols_sql_intercept, register
from strataframe.sources.fixtures import award, batting_year, fielding, person, salary

FIT_YEARS = (1995, 2000)
DEBUT_WINDOW = ("1995-01-01", "1997-01-01")   # (exclusive, inclusive]
NOT_BATTING = "5-LOW"                           # the position that does not bat
PROFILE_COLS = ["BB", "singles", "doubles", "triples", "HR", "AVG", "R_hat"]


def roster_players(spark, d):
    """Players with predicted runs, salary, modal position and names."""
    fit = ols(team_rates_all(spark, d, FIT_YEARS), "R", FIVE)
    players = fit.predict(player_rates(spark, d), out="R_hat")
    players = verbs.right_join(salary(spark, d), players, ["playerID"])
    players = (verbs.right_join(modal_position(spark, d), players, ["playerID"])
               .filter(F.col("POS").isNotNull() & F.col("salary").isNotNull()))
    names = person(spark, d).select("playerID", "nameFirst", "nameLast",
                                    F.try_to_date("debut").alias("debut"))
    return verbs.right_join(names, players, ["playerID"])


_b0, _ = ols_sql_intercept(5)
_pred = " + ".join(f"fr_fit.a_{j}_5 * p.{x}" for j, x in enumerate(FIVE))
ROSTER_CTES = {
    **ols_sql_ctes("fr", rates_sql("where yearID between 1995 and 2000"), "R", FIVE),
    "scored": f"select p.*, ({_b0}) + {_pred} as R_hat from {PLAYERS_SQL} p, fr_fit",
    "roster_all": f"""
        select pe.nameFirst, pe.nameLast, cast(pe.debut as date) as debut, m.POS, s.salary, sc.*
        from scored sc left join salary s using (playerID) left join {MODAL_SQL} m using (playerID)
        left join person pe using (playerID)
        where m.POS is not null and s.salary is not null""",
    "candidates": f"""select * from roster_all
        where debut <= date '{DEBUT_WINDOW[1]}' and debut > date '{DEBUT_WINDOW[0]}'""",
    "sky": """select c.* from candidates c where not exists (
        select 1 from candidates o where o.POS = c.POS and o.salary <= c.salary
          and o.R_hat >= c.R_hat and (o.salary < c.salary or o.R_hat > c.R_hat))""",
}


@register("roster", """
    select playerID, nameFirst, nameLast, POS, salary, R_hat from roster_all
    qualify rank() over (order by R_hat desc) <= 10""", "salary R_hat", ROSTER_CTES)
def q_roster(spark, d):
    p = roster_players(spark, d).select("playerID", "nameFirst", "nameLast", "POS", "salary",
                                        "R_hat")
    return verbs.top_n(p, 10, "R_hat")


def candidates(spark, d):
    return roster_players(spark, d).filter((F.col("debut") <= F.lit(DEBUT_WINDOW[1]).cast("date"))
                    & (F.col("debut") > F.lit(DEBUT_WINDOW[0]).cast("date")))


@register("skyline", "select POS, playerID, salary, R_hat from sky", "salary R_hat", ROSTER_CTES)
def q_skyline(spark, d):
    pool = candidates(spark, d).select("POS", "playerID", "salary", "R_hat")
    return verbs.skyline(pool, ["POS"], "salary", "R_hat").select(
        "POS", "playerID", "salary", "R_hat")


@register("selection_table", """
    select POS, playerID, salary, R_hat, count(*) over (partition by POS) as n_in_pos
    from candidates""", "salary R_hat", ROSTER_CTES)
def q_selection_table(spark, d):
    """Long (category, entity, cost, value) rows with the category incidence count (C4)."""
    c = candidates(spark, d).select("POS", "playerID", "salary", "R_hat")
    n = c.groupBy("POS").agg(F.count("*").alias("n_in_pos"))
    return c.join(n, "POS")


_MED = ", ".join(f"median({c}) as med_{c}, 1.4826 * mad({c}) as mad_{c}" for c in PROFILE_COLS)
_SCALED = ", ".join(f"({c} - med_{c}) / mad_{c} as {c}" for c in PROFILE_COLS)


@register("profile", f"""
    select playerID, nameFirst, nameLast, {_SCALED}
    from roster_all, (select {_MED} from roster_all)
    where playerID in (select playerID from sky)""", " ".join(PROFILE_COLS), ROSTER_CTES)
def q_profile(spark, d):
    """Chosen players on the robust scale of all players (C6): scale first, then filter."""
    players = roster_players(spark, d)
    allp = players.select("playerID", "nameFirst", "nameLast", *PROFILE_COLS)
    scaled = scale.robust_scale(allp, PROFILE_COLS)
    chosen = verbs.skyline(candidates(spark, d), ["POS"], "salary", "R_hat").select(
        "playerID")
    return verbs.semi_join(scaled, chosen, ["playerID"])


def player_info(spark, d):
    """Most-played position row per player with names (W1 + J1)."""
    top = verbs.first_per_group(fielding(spark, d), ["playerID"], "G", "stint").select(
        "playerID", "POS")
    names = person(spark, d).select("playerID", "nameFirst", "nameLast")
    return verbs.left_join(top, names, ["playerID"]).select("playerID", "nameFirst", "nameLast",
                                                            "POS")


INFO_SQL = """(select f.playerID, p.nameFirst, p.nameLast, f.POS from (
                 select playerID, POS from fielding
                 qualify row_number() over (partition by playerID order by G desc, stint) = 1) f
               left join person p using (playerID))"""


@register("rookie_sophomore", f"""
    select playerID, rookie_year, nameFirst, nameLast,
           max(case when rookie = 'rookie' then AVG end) as rookie,
           max(case when rookie = 'sophomore' then AVG end) as sophomore
    from (select *, case when yearID = min(yearID) over (partition by playerID) then 'rookie'
                         else 'sophomore' end as rookie
          from (select a.playerID, a.yearID as rookie_year, i.nameFirst, i.nameLast, i.POS,
                       b.yearID, b.H / b.AB as AVG
                from award a left join {INFO_SQL} i using (playerID)
                right join batting_year b using (playerID)
                where i.POS <> '{NOT_BATTING}'
                  and (b.yearID = a.yearID or b.yearID = a.yearID + 1))
          qualify count(*) over (partition by playerID) = 2)
    group by playerID, rookie_year, nameFirst, nameLast""", "rookie sophomore")
def q_rookie_sophomore(spark, d):
    roy = verbs.left_join(award(spark, d), player_info(spark, d), ["playerID"])
    roy = roy.withColumnRenamed("yearID", "rookie_year")
    roy = verbs.right_join(roy, batting_year(spark, d), ["playerID"])
    roy = roy.withColumn("AVG", safe_div("H", "AB")).filter(F.col("POS") != NOT_BATTING)
    roy = roy.filter((F.col("yearID") == F.col("rookie_year"))
                     | (F.col("yearID") == F.col("rookie_year") + 1))
    roy = verbs.label_extreme(roy, ["playerID"], "yearID", "rookie", "rookie", "sophomore")
    roy = verbs.filter_group(roy, ["playerID"], [F.count("*").alias("_n")], F.col("_n") == 2)
    roy = roy.select("playerID", "rookie_year", "rookie", "nameFirst", "nameLast", "AVG")
    wide = reshape.spread(roy, ["playerID", "rookie_year", "nameFirst", "nameLast"], "rookie",
                          "AVG", ["rookie", "sophomore"])
    return wide.orderBy(F.col("rookie").desc_nulls_last())


@register("two_seasons", f"""
    select w.playerID, i.nameFirst, i.nameLast, w."1996", w."1997"
    from {PAIRED_SQL} w left join {INFO_SQL} i using (playerID)
    where i.POS <> '{NOT_BATTING}'""", ["1996", "1997"])
def q_two_seasons(spark, d):
    from strataframe.operators.infer import paired_change

    wide = paired_change(qualified_avg(spark, d), ["playerID"], "yearID", "AVG", 1996, 1997)
    j = verbs.left_join(wide, player_info(spark, d), ["playerID"])
    j = j.filter(F.col("POS") != NOT_BATTING).drop("POS")
    return (j.orderBy(F.col("`1996`").desc_nulls_last())
            .select("playerID", "nameFirst", "nameLast", "1996", "1997"))
