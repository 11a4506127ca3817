"""Stored layouts that spare shuffles, and join forms the optimizer is to see through."""

import uuid

import pytest
from pyspark.sql import functions as F

from strataframe.operators import verbs
from strataframe.plans import catalog
from strataframe.sources.tables import load, write_bucketed
from tests.conftest import SF001


def plan(df, optimized=False):
    q = df._jdf.queryExecution()
    return (q.optimizedPlan() if optimized else q.executedPlan()).toString()


@pytest.fixture
def stored(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    orders = load(spark, SF001, "orders").withColumn("year", F.year("o_orderdate"))
    lines = load(spark, SF001, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    names = [f"orders_{tag}", f"lines_{tag}"]
    yield (write_bucketed(orders, names[0], str(tmp_path / "o"), ["o_orderkey"], 4, ["year"]),
           write_bucketed(lines, names[1], str(tmp_path / "l"), ["o_orderkey"], 4), orders, lines)
    for name in names:
        spark.sql(f"drop table if exists {name}")


def test_bucketed_tables_join_without_an_exchange(spark, stored):
    orders, lines, plain_orders, plain_lines = stored
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for join in (verbs.left_join, verbs.right_join):
            joined = join(lines, orders, ["o_orderkey"], null_matches=False)
            assert "Exchange" not in plan(joined) and "Exchange" in plan(join(plain_lines, plain_orders, ["o_orderkey"], null_matches=False))
            assert joined.count() == join(plain_lines, plain_orders, ["o_orderkey"]).count()
        per = lines.groupBy("o_orderkey").agg(F.sum("l_quantity").alias("q"))
        assert "Exchange" not in plan(per)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_folders_are_pruned(stored):
    orders, _, plain_orders, _ = stored
    some = orders.filter(F.col("year") == 1996)
    line = next(x for x in plan(some).split("\n") if "FileScan" in x)
    assert "PartitionFilters: [isnotnull(year" in line and some.count() == plain_orders.filter("year = 1996").count() > 0


def test_outer_joins_become_inner_where_a_filter_needs_the_other_side(spark):
    left = load(spark, SF001, "customer").select(F.col("c_custkey").alias("k"), "c_acctbal")
    right = load(spark, SF001, "orders").select(F.col("o_custkey").alias("k"), "o_totalprice")
    for how, c in ((verbs.right_join, "c_acctbal"), (verbs.left_join, "o_totalprice")):
        joined = how(left, right, ["k"])
        assert "Outer" in plan(joined, True)
        strict = joined.filter(F.col(c).isNotNull())
        assert "Join Inner" in plan(strict, True) and "Outer" not in plan(strict, True)


def test_a_literal_table_goes_to_every_task(spark, tmp_path):
    """Two names joined to many rows of one key: the rows stay in the tasks that read them."""
    rows = spark.createDataFrame([(k, 1.0) for k in ("A", "A", "A", "A", "R", "N", None)], "l_returnflag string, l_quantity double")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no side is small, as at size
    try:
        named = catalog.QUERIES["literal_join"](spark, str(tmp_path))
        assert {tuple(r) for r in named.collect()} == {("accepted", 4, 4.0), ("returned", 1, 1.0)}
        assert "BroadcastHashJoin" in plan(named) and "SortMergeJoin" not in plan(named)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
