"""Inputs shaped like the tables the analyses were written for, derived from the test tables.

Each derivation exists twice: as a Spark plan (the function) and as DuckDB SQL (the
``FIXTURE_SQL`` entry of the same name) so that every query can be checked by an oracle.
The mapping is documented in FIXTURES.md (Part B).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.functions.columns import normal_pair_sql
from strataframe.sources.tables import load, normal_panel

EPOCH_2024_US = 1704067200 * 1_000_000
DAY_US = 86400.0 * 1_000_000
PANEL_SEED = 2024
PANEL_N = 25


def _yr(c):
    return F.year(F.col(c)).cast("int")


def in_years(df: DataFrame, c: str, years: tuple[int, int] | None) -> DataFrame:
    """Rows whose timestamp ``c`` is in the years first..last: a half-open range on the stored column,
    which reaches the scan (a condition on ``year(c)`` does not)."""
    if years is None:
        return df
    bound = lambda y: F.lit(f"{y}-01-01 00:00:00").cast(df.schema[c].dataType)
    return df.filter((F.col(c) >= bound(years[0])) & (F.col(c) < bound(years[1] + 1)))


def team_season(spark: SparkSession, d: str, years: tuple[int, int] | None = None) -> DataFrame:
    li = in_years(load(spark, d, "lineitem"), "l_shipdate", years)
    q = F.col("l_quantity")

    def qty_if(cond):
        return F.sum(F.when(cond, q).otherwise(F.lit(0.0)))

    return (li.groupBy(F.col("l_suppkey").alias("teamID"), _yr("l_shipdate").alias("yearID"))
            .agg(F.count("*").alias("G"),
                 (F.sum("l_extendedprice") / 1000.0).alias("R"),
                 qty_if(F.col("l_returnflag") == "R").alias("HR"),
                 qty_if(F.col("l_returnflag") == "A").alias("BB"),
                 qty_if(F.col("l_returnflag") == "N").alias("SB"),
                 F.sum(q).alias("H"),
                 (qty_if(F.col("l_linestatus") == "O") / 4.0).alias("X2B"),
                 F.count_if(F.col("l_discount") >= 0.08).alias("X3B"),
                 F.count_if(F.col("l_tax") >= 0.04).alias("W"),
                 F.count_if(F.col("l_tax") == 0).alias("E"))
            .withColumn("AB", F.col("H") + 3.0 * F.col("G")))


def batting(spark: SparkSession, d: str, years: tuple[int, int] | None = None) -> DataFrame:
    o = in_years(load(spark, d, "orders"), "o_orderdate", years)
    k = F.col("o_orderkey")
    ab = F.floor(F.col("o_totalprice") / 100).cast("int")
    return o.select(
        F.col("o_custkey").alias("playerID"),
        _yr("o_orderdate").alias("yearID"),
        k.alias("stint"),
        (F.col("o_custkey") % 30).alias("teamID"),
        ((k % 150) + 1).cast("int").alias("G"),
        ab.alias("AB"),
        (ab % 100).alias("H"),
        (k % 13).cast("int").alias("BB"),
        (k % 7).cast("int").alias("HR"),
        (k % 5).cast("int").alias("X2B"),
        (k % 3).cast("int").alias("X3B"))


def batting_year(spark: SparkSession, d: str, years: tuple[int, int] | None = None) -> DataFrame:
    cols = ["G", "AB", "H", "BB", "HR", "X2B", "X3B"]
    return (batting(spark, d, years).groupBy("playerID", "yearID")
            .agg(*[F.sum(c).alias(c) for c in cols]))


def person(spark: SparkSession, d: str) -> DataFrame:
    first = (load(spark, d, "orders").groupBy(F.col("o_custkey").alias("playerID"))
             .agg(F.min("o_orderdate").alias("first_order")))
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("playerID"),
                                          F.col("c_name").alias("nameFirst"),
                                          F.col("c_mktsegment").alias("nameLast"))
    return (c.join(first, "playerID", "left")
            .select("playerID", "nameFirst", "nameLast",
                    F.date_format("first_order", "yyyy-MM-dd").alias("debut")))


def salary(spark: SparkSession, d: str) -> DataFrame:
    """Four customers of five (FIXTURES.md), so that outer joins have rows without a partner."""
    return (load(spark, d, "customer").filter(F.col("c_custkey") % 5 != 0)
            .select(F.col("c_custkey").alias("playerID"), F.col("c_acctbal").alias("salary")))


APPEARANCE_COLS = ["G_1", "G_2", "G_3", "G_4", "G_5"]


def appearances(spark: SparkSession, d: str) -> DataFrame:
    pr = F.substring("o_orderpriority", 1, 1)
    return (load(spark, d, "orders").groupBy(F.col("o_custkey").alias("playerID"))
            .agg(*[F.count_if(pr == c[-1]).alias(c) for c in APPEARANCE_COLS]))


def fielding(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "orders").select(
        F.col("o_custkey").alias("playerID"), F.col("o_orderpriority").alias("POS"),
        F.floor("o_totalprice").cast("int").alias("G"), F.col("o_orderkey").alias("stint"))


def award(spark: SparkSession, d: str) -> DataFrame:
    """One customer of three (FIXTURES.md): the few players with an award."""
    first = (load(spark, d, "orders").groupBy(F.col("o_custkey").alias("playerID"))
             .agg(F.min(_yr("o_orderdate")).alias("yearID")))
    c = (load(spark, d, "customer").filter(F.col("c_custkey") % 3 == 0)
         .select(F.col("c_custkey").alias("playerID"), F.col("c_mktsegment").alias("awardID")))
    return c.join(first, "playerID").select("playerID", "awardID", "yearID")


def children(spark: SparkSession, d: str) -> DataFrame:
    """The family table without the numbering of its children."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    father = F.lit(60.0) + (F.col("c_acctbal") + 1000.0) / 1000.0
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("family"),
        F.col("o_orderkey").alias("child_id"),
        father.alias("father"),
        (F.lit(60.0) + (F.col("o_custkey") % 11).cast("double")).alias("mother"),
        F.when(F.col("o_orderkey") % 2 == 0, "male").otherwise("female").alias("gender"),
        (F.lit(40.0) + 0.5 * father + F.col("o_totalprice") / 50000.0).alias("childHeight"))


def family(spark: SparkSession, d: str) -> DataFrame:
    """``children`` with childNum: the row number within the family by child_id."""
    from strataframe.operators.ranks import positions

    ranked = positions(children(spark, d), by=["family"], order=["child_id"])
    return ranked.withColumn("childNum", (F.col("_pos") + 1).cast("int")).drop("_pos")


def admissions(spark: SparkSession, d: str) -> DataFrame:
    return (load(spark, d, "lineitem")
            .groupBy(F.col("l_returnflag").alias("major"), F.col("l_linestatus").alias("gender"))
            .agg(F.count("*").alias("applicants"),
                 F.bround(100.0 * F.avg((F.col("l_discount") > 0.05).cast("int")), 0)
                 .alias("admitted")))


def events_xy(spark: SparkSession, d: str) -> DataFrame:
    ev = load(spark, d, "events")
    # timestamp_ntz arithmetic: independent of the session time zone
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)")
    return ev.select(F.col("event_id"), F.col("user_id").alias("group"),
                     (us.cast("double") / DAY_US).alias("time"),
                     F.col("value").alias("observed_distance"),
                     F.col("event_type"))


def sim_panel(spark: SparkSession, d: str) -> DataFrame:
    """25 normal (x, y) draws per order: the panel grows with the orders table."""
    return normal_panel(load(spark, d, "orders"), "o_orderkey", PANEL_N, PANEL_SEED)


BUILDERS = {f.__name__: f for f in (team_season, batting, batting_year, person, salary,
                                    appearances, fielding, award, family, admissions,
                                    events_xy, sim_panel)}


def fixture(spark: SparkSession, d: str, name: str) -> DataFrame:
    return BUILDERS[name](spark, d)


# ------------------------------------------------------------------ DuckDB twins
FIXTURE_SQL = {
    "team_season": """
        select l_suppkey as teamID, cast(year(l_shipdate) as integer) as yearID,
               count(*) as G, sum(l_extendedprice) / 1000.0 as R,
               sum(case when l_returnflag = 'R' then l_quantity else 0.0 end) as HR,
               sum(case when l_returnflag = 'A' then l_quantity else 0.0 end) as BB,
               sum(case when l_returnflag = 'N' then l_quantity else 0.0 end) as SB,
               sum(l_quantity) as H,
               sum(case when l_linestatus = 'O' then l_quantity else 0.0 end) / 4.0 as X2B,
               cast(count_if(l_discount >= 0.08) as bigint) as X3B,
               cast(count_if(l_tax >= 0.04) as bigint) as W,
               cast(count_if(l_tax = 0) as bigint) as E,
               sum(l_quantity) + 3.0 * count(*) as AB
        from lineitem group by 1, 2""",
    "batting": """
        select o_custkey as playerID, cast(year(o_orderdate) as integer) as yearID,
               o_orderkey as stint, o_custkey % 30 as teamID,
               cast(o_orderkey % 150 + 1 as integer) as G,
               cast(floor(o_totalprice / 100) as integer) as AB,
               cast(floor(o_totalprice / 100) as integer) % 100 as H,
               cast(o_orderkey % 13 as integer) as BB, cast(o_orderkey % 7 as integer) as HR,
               cast(o_orderkey % 5 as integer) as X2B, cast(o_orderkey % 3 as integer) as X3B
        from orders""",
    "batting_year": """
        select playerID, yearID, cast(sum(G) as bigint) as G, cast(sum(AB) as bigint) as AB,
               cast(sum(H) as bigint) as H, cast(sum(BB) as bigint) as BB,
               cast(sum(HR) as bigint) as HR, cast(sum(X2B) as bigint) as X2B,
               cast(sum(X3B) as bigint) as X3B
        from batting group by 1, 2""",
    "person": """
        select c_custkey as playerID, c_name as nameFirst, c_mktsegment as nameLast,
               strftime(f.first_order, '%Y-%m-%d') as debut
        from customer left join (select o_custkey, min(o_orderdate) as first_order
                                 from orders group by 1) f on f.o_custkey = c_custkey""",
    "salary": "select c_custkey as playerID, c_acctbal as salary from customer "
              "where c_custkey % 5 <> 0",
    "appearances": """
        select o_custkey as playerID,
               cast(count_if(substr(o_orderpriority, 1, 1) = '1') as bigint) as G_1,
               cast(count_if(substr(o_orderpriority, 1, 1) = '2') as bigint) as G_2,
               cast(count_if(substr(o_orderpriority, 1, 1) = '3') as bigint) as G_3,
               cast(count_if(substr(o_orderpriority, 1, 1) = '4') as bigint) as G_4,
               cast(count_if(substr(o_orderpriority, 1, 1) = '5') as bigint) as G_5
        from orders group by 1""",
    "fielding": "select o_custkey as playerID, o_orderpriority as POS, "
                "cast(floor(o_totalprice) as integer) as G, o_orderkey as stint from orders",
    "award": """
        select c_custkey as playerID, c_mktsegment as awardID, f.yearID
        from customer join (select o_custkey, cast(min(year(o_orderdate)) as integer) as yearID
                            from orders group by 1) f on f.o_custkey = c_custkey
        where c_custkey % 3 = 0""",
    "family": """
        select o_custkey as family, o_orderkey as child_id,
               60.0 + (c_acctbal + 1000.0) / 1000.0 as father,
               60.0 + cast(o_custkey % 11 as double) as mother,
               case when o_orderkey % 2 = 0 then 'male' else 'female' end as gender,
               40.0 + 0.5 * (60.0 + (c_acctbal + 1000.0) / 1000.0) + o_totalprice / 50000.0
                 as childHeight,
               cast(row_number() over (partition by o_custkey order by o_orderkey) as integer)
                 as childNum
        from orders join customer on o_custkey = c_custkey""",
    "admissions": """
        select l_returnflag as major, l_linestatus as gender, count(*) as applicants,
               round_even(100.0 * avg(case when l_discount > 0.05 then 1 else 0 end), 0)
                 as admitted
        from lineitem group by 1, 2""",
    "events_xy": f"""
        select event_id, user_id as "group",
               cast(epoch_us(ts) - {EPOCH_2024_US} as double) / {DAY_US!r} as time,
               value as observed_distance, event_type
        from events""",
    "sim_panel": f"""
        select o_orderkey as "group", cast(t.i as integer) as i,
               {normal_pair_sql(PANEL_SEED, 'o_orderkey', 'cast(t.i as integer)')[0]} as x,
               {normal_pair_sql(PANEL_SEED, 'o_orderkey', 'cast(t.i as integer)')[1]} as y
        from orders, range({PANEL_N}) t(i)""",
}


def with_fixtures(sql: str, extra_ctes: dict | None = None) -> str:
    """Prefix ``sql`` with the fixture CTEs it mentions (dependencies first)."""
    ctes = dict(FIXTURE_SQL)
    ctes.update(extra_ctes or {})
    order: list[str] = []

    def visit(text):
        for name in ctes:
            if name not in order and re.search(rf"\b{name}\b", text):
                order.append(name)  # reserve the slot to stop self-recursion
                visit(ctes[name])
                order.remove(name)
                order.append(name)

    visit(sql)
    if not order:
        return sql
    body = ",\n".join(f"{n} as ({ctes[n]})" for n in order)
    return f"with recursive {body}\n{sql}"
