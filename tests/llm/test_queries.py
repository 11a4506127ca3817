import duckdb
import pytest

import __spark_entry__ as entry
from strataframe.llm.queries import ORACLE, QUERIES
from tests.conftest import SF001, SF01


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"create view {table} as select * from read_parquet('{SF001}/{table}.parquet')")
    want = con.sql(ORACLE[name]).df()
    got = QUERIES[name](spark, SF001).toPandas()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert sorted(map(repr, got[columns].values.tolist())) == sorted(map(repr, want[columns].values.tolist()))


@pytest.mark.parametrize("name", ["op4_token_output", "op6_best_fit_packing", "op7_simhash", "op9_suffix_array"])
def test_partitions_change_nothing(spark, name):
    old, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    drop = {"sequence_id", "offset"}
    try:
        for parts in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            frame = QUERIES[name](spark, SF001)
            got.append(sorted(map(tuple, frame.select([c for c in frame.columns if c not in drop]).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_contract_columns(spark):
    kinds = {"op1_token_counts": "doc_id n_words n_tokens", "op5_quality": "doc_id held_out score predicted"}
    for name, columns in kinds.items():
        assert QUERIES[name](spark, SF01).columns == columns.split()
