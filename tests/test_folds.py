"""User functions by partial, merge and finish; grids; wide correlation matrices; sketches; heavy keys."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataframe.operators import aggs, fold, heavy, infer, sketch, verbs
from strataframe.plans.folds import finish_line, line_state, merge_lines


@pytest.fixture(scope="module")
def rows(spark):
    """Half of all rows in one group, a NULL group, a group of one row."""
    rng = np.random.default_rng(2)
    g = rng.choice(["hot", "hot", "b", None], 6000)
    g[17] = "one"
    pdf = pd.DataFrame({"g": g, "time": rng.random(6000) + 1e6, "v": rng.random(6000)})
    return spark.createDataFrame(pdf, "g string, time double, v double").repartition(9), pdf


def by_group(found):
    return {(r[0], r[1]): r[2] for r in found}


def test_split_groups_equal_one_task(spark, rows, monkeypatch):
    df, pdf = rows
    monkeypatch.setattr(fold, "KEPT_NUMBERS", 30)  # states are passed on again and again

    def whole(part):
        state = line_state({c: part[c].to_numpy() for c in ("time", "v")})
        return pd.DataFrame([(part.g.iloc[0], *r) for r in finish_line(state)], columns=["g", "term", "estimate"])

    one = by_group(verbs.per_group(df, ["g"], whole, "g string, term string, estimate double").collect())
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        split = fold.fold_groups(df, ["g"], ["time", "v"], line_state, merge_lines, finish_line, "term string, estimate double")
        got = by_group(split.collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == set(one) and len(got) == 8
    for key, value in one.items():
        assert (got[key] is None and value is None) or got[key] == pytest.approx(value, rel=1e-6)
    for key, part in (("hot", pdf[pdf.g == "hot"]), (None, pdf[pdf.g.isna()])):
        assert got[key, "time"] == pytest.approx(np.polyfit(part.time - 1e6, part.v, 1)[0], rel=1e-6)


def test_no_group_and_no_rows(rows):
    df, pdf = rows
    fit = fold.fold_groups(df, [], ["time", "v"], line_state, merge_lines, finish_line, "term string, estimate double")
    assert dict(fit.collect())["time"] == pytest.approx(np.polyfit(pdf.time - 1e6, pdf.v, 1)[0], rel=1e-6)
    assert fold.fold_groups(df.limit(0), ["g"], ["time", "v"], line_state, merge_lines, finish_line, "term string, estimate double").count() == 0
    with pytest.raises(ValueError, match="schema"):
        fold.fold_groups(df, ["g"], ["v"], line_state, merge_lines, finish_line, "")


def test_any_loss_over_a_grid(spark, rows):
    df, pdf = rows
    grid = np.linspace(-1, 2, 700).tolist()
    loss = lambda t, b: np.abs(t["v"] - b)
    got = {(r.g, r.i): r.loss for r in fold.grid_sums(df, ["v"], grid, loss, ["g"]).collect()}
    for key, part in (("hot", pdf[pdf.g == "hot"]), ("one", pdf[pdf.g == "one"])):
        assert [got[key, i] for i in range(700)] == pytest.approx(np.abs(part.v.to_numpy()[:, None] - grid).sum(0).tolist())
    holes = df.withColumn("v", F.when(F.col("g") == "hot", F.col("v")))
    assert fold.grid_sums(holes, ["v"], [0.0, 1.0], loss).select("loss").collect() == [(None,), (None,)]
    with pytest.raises(ValueError, match="bound"):
        fold.grid_sums(df, ["v"], range(fold.MOST_POINTS + 1), loss)


def test_two_hundred_columns_in_one_pass(spark):
    rng = np.random.default_rng(4)
    k = 200
    x = rng.normal(size=(300, k)) @ rng.normal(size=(k, k)) + 1e5
    x[:, 7], x[5, 9] = 3.0, np.nan
    names = [f"c{i}" for i in range(k)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(5).replace(float("nan"), None)
    found = fold.corr_matrix_wide(df, names)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    got = {(r.var1, r.var2): r.r for r in found.collect()}
    want = np.corrcoef(np.delete(x, [7, 9], 1), rowvar=False)
    left = [n for i, n in enumerate(names) if i not in (7, 9)]
    assert len(got) == k * (k - 1) // 2
    assert all(got[a, b] == pytest.approx(want[i, j], rel=1e-7, abs=1e-9) for i, a in enumerate(left) for j, b in enumerate(left) if i < j)
    assert got["c3", "c7"] is None and got["c9", "c11"] is None
    small = {(r.var1, r.var2): r.r for r in aggs.corr_matrix(df, names[:12]).collect()}
    assert all((got[p] is None) == (r is None) and (r is None or got[p] == pytest.approx(r, rel=1e-7)) for p, r in small.items())


def test_sketches_merge_and_keep_their_bound(spark):
    df = spark.range(60000).select((F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("b"), F.xxhash64("id").cast("double").alias("v"))
    fine = sketch.quantile_sketches(df, "v", ["a", "b"])
    got = sketch.sketch_quantiles(sketch.merged_sketches(fine, ["b"]), [0.05, 0.5, 0.95], ["b"]).collect()
    for b in (0, 1):
        v = np.array([r.v for r in df.filter(F.col("b") == b).collect()])
        for r in got:
            if r.b == b:
                assert r.value in v and abs((v <= r.value).mean() - r.prob) <= 2 * sketch.rank_error()
    none = sketch.quantile_sketches(df.withColumn("v", F.lit(None).cast("double")), "v", ["b"])
    assert [r.value for r in sketch.sketch_quantiles(none, [0.5], ["b"]).collect()] == [None, None]


def test_heavy_keys_are_spread(spark):
    """Half of the rows have one key, some have NULL: same rows as a plain join, no task far above the median."""
    left = spark.range(40000).select(F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id")).alias("k"),
                                     F.lit("x").alias("same"))
    right = spark.range(0, 40000, 3).select(F.col("id").alias("k"), F.col("id").alias("w")).union(spark.createDataFrame([(None, -1), (7, 70)], "k long, w long"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = heavy.join_heavy(left, right, ["k"], how, parts=8)
        want = verbs.join_by(left, right, ["k"], how)
        assert got.columns == want.columns
        cols = got.columns
        assert got.groupBy(*cols).count().exceptAll(want.groupBy(*cols).count()).count() == 0 and got.count() == want.count()
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        tasks = [sorted(r["count"] for r in t.groupBy(F.spark_partition_id()).count().collect())
                 for t in (heavy.join_heavy(left, right, ["k"], "left", parts=16), verbs.join_by(left, right, ["k"], "left"))]
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert tasks[0][-1] < 2 * np.median(tasks[0]) < tasks[1][-1]
    with pytest.raises(ValueError):
        heavy.join_heavy(left, right, ["k"], "right")


def test_undominated_rows_of_odd_types(spark):
    import datetime as dt
    import decimal

    rng = np.random.default_rng(0)
    data = [(rng.choice(["a", "b", None]), dt.date(2024, 1, 1) + dt.timedelta(int(rng.integers(0, 30))), decimal.Decimal(int(rng.integers(0, 30))) / 4, i)
            for i in range(400)] + [("a", None, decimal.Decimal(9), 400), ("b", dt.date(2020, 1, 1), None, 401), ("a", dt.date(2020, 1, 1), decimal.Decimal(1), 402)] * 2
    df = spark.createDataFrame(data, "g string, cost date, value decimal(10,2), id int").repartition(6)
    got = sorted(r.id for r in verbs.skyline(df, ["g"], "cost", "value").collect())
    full = [r for r in data if r[1] is not None and r[2] is not None]
    want = sorted(r[3] for r in full if not any(o[0] == r[0] and o[1] <= r[1] and o[2] >= r[2] and (o[1] < r[1] or o[2] > r[2]) for o in full))
    assert got == want
    everything = sorted(r.id for r in verbs.skyline(df, [], "cost", "value").collect())
    assert set(everything) <= set(got) and 402 in everything
    assert verbs.skyline(df.limit(0), ["g"], "cost", "value").count() == 0


def test_chi_square_tail_and_excluded_rows(spark):
    table = spark.createDataFrame([("a", 300, 100), ("b", 100, 300)], "g string, yes long, no long")
    p = infer.chisq_2x2(table, "yes", "no").first()
    assert p["statistic"] == pytest.approx(198.005) and p["p_value"] == pytest.approx(math.erfc(math.sqrt(198.005 / 2)), rel=1e-9)
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 1.0), (None, 3.0, 5.0), (3, None, 7.0)], "k int, x double, y double")
    none, without = infer.corr_excluding(df, "x", "y", "k", 99).first(), infer.corr_excluding(df, "x", "y", "k", 3).first()
    assert tuple(none) == (None, None) and without["r_without"] == pytest.approx(np.corrcoef([1, 2, 3], [2, 1, 5])[0, 1])


def test_sorts_have_every_row_in_order(spark):
    data = [(3, "b"), (None, "a"), (1, "c"), (3, "a"), (2, None)]
    df = spark.createDataFrame(data, "x int, s string").repartition(3)
    assert [tuple(r) for r in verbs.sort_asc(df, "x", "s").collect()] == [(1, "c"), (2, None), (3, "a"), (3, "b"), (None, "a")]
    assert [tuple(r) for r in verbs.sort_desc(df, "x", "s").collect()] == [(3, "b"), (3, "a"), (2, None), (1, "c"), (None, "a")]
