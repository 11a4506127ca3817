"""The driver contract: entry() on sf0.001, and every registered query on sf0.001."""

import re

import pytest

import __spark_entry__ as entry
from strataframe.plans import catalog
from tests.conftest import SF001


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "slope" in df.columns


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 70


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_smoke(spark, name):
    df = entry.queries()[name](spark, SF001)
    df.collect()
    assert len(df.columns) > 0


@pytest.mark.parametrize("name", ["avg_rank", "median_mad", "ols1_by", "qq_normal", "nested_fit"])
def test_results_do_not_depend_on_partition_count(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("3", "11", "50"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append(sorted(repr(tuple(r)) for r in entry.queries()[name](spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1] == got[2]


def test_no_cross_join_in_any_plan(spark):
    for name, q in sorted(catalog.QUERIES.items()):
        plan = q(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_filters_and_projection_reach_the_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = entry.queries()["filters"](spark, SF001)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = next(line for line in plan.split("\n") if "FileScan parquet" in line)
    assert "EqualTo(l_returnflag,R)" in scan and "EqualTo(l_linestatus,F)" in scan
    assert "l_extendedprice" not in scan       # column pruning: unused columns are not read


YEARLY = ("rates mutate_overwrite filters corr_all corr_matrix ratio_of_sums nested_agg summarize_seq right_join spread_int append "
          "ols2 ols5 predict glance inference paired_change two_seasons roster selection_table").split()


@pytest.mark.parametrize("name", YEARLY)
def test_year_filters_reach_the_scan(spark, name):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = entry.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "GreaterThanOrEqual(l_shipdate" in plan or "GreaterThanOrEqual(o_orderdate" in plan


def test_no_window_over_a_whole_table(spark):
    """A window without a partition only runs over one row per range or over the counts around a bracket."""
    for name, q in sorted(catalog.QUERIES.items()):
        lines = q(spark, SF001)._jdf.queryExecution().executedPlan().toString().split("\n")
        for k, line in enumerate(lines[:-3]):
            if "- Window " in line and "Exchange SinglePartition" in lines[k + 2]:
                assert re.search(r"HashAggregate\(keys=\[(_r#|.*_gap#)", lines[k + 3]), name
