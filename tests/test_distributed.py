"""Order statistics and scaling that never gather a group in one task, checked against
pandas on a table where one group holds most rows (the skew case)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataframe.operators import binning, ranks, scale, verbs


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    g = np.array([1] * 600 + [2] * 40 + [3] * 1 + [4] * 2)
    v = rng.integers(0, 50, len(g)).astype(float)
    pdf = pd.DataFrame({"g": g, "v": v, "k": np.arange(len(g))})
    return spark.createDataFrame(pdf), pdf


def test_positions_and_ranks(skewed):
    df, pdf = skewed
    got = ranks.positions(df, ["g"], ["v", "k"]).toPandas()
    exp = pdf.sort_values(["g", "v", "k"]).assign(e=lambda x: x.groupby("g").cumcount())
    m = got.merge(exp, on=["g", "v", "k"])
    assert len(m) == len(pdf) and (m["_pos"] == m["e"]).all()
    r = ranks.avg_rank(df, "v", ["g"]).toPandas().merge(pdf, on=["g", "v", "k"])
    r["e"] = r.groupby("g")["v"].rank()
    assert np.allclose(r["v_rank"], r["e"])
    glob = ranks.avg_rank(df, "v").toPandas()
    assert np.allclose(glob.sort_values("k")["v_rank"], pdf.sort_values("k")["v"].rank())


def test_running_max_before(skewed):
    df, pdf = skewed
    got = ranks.running_before(df, ["g"], ["k"], "v", "max", "m").toPandas()
    exp = pdf.sort_values(["g", "k"])
    exp["e"] = exp.groupby("g")["v"].transform(lambda s: s.shift().cummax())
    m = got.merge(exp, on=["g", "k"])
    assert ((m["m"] == m["e"]) | (m["m"].isna() & m["e"].isna())).all()


def test_quantiles_median_mad(skewed):
    df, pdf = skewed
    q = ranks.quantiles(df, "v", [0, 0.25, 0.5, 0.75, 1], ["g"]).toPandas().set_index("g")
    for g, sub in pdf.groupby("g"):
        assert np.allclose(q.loc[g].values, np.quantile(sub.v, [0, .25, .5, .75, 1]))
    m = ranks.mad(df, "v").first()
    med = np.median(pdf.v)
    assert m["median"] == med and m["mad"] == pytest.approx(1.4826 * np.median(np.abs(pdf.v - med)))


@pytest.mark.parametrize("accuracy", [20, 300])
def test_selection_by_brackets(spark, monkeypatch, accuracy):
    """Groups far larger than a bracket: heavy ties, one group with half of all rows, NULLs, odd doubles, near probs."""
    monkeypatch.setattr(ranks, "ACCURACY", accuracy)
    rng = np.random.default_rng(accuracy)
    g = rng.choice([1, 1, 1, 2, 3, 4], 12000)
    v = np.where(g == 2, rng.integers(0, 7, len(g)), np.where(g == 3, rng.normal(size=len(g)) * 10.0 ** rng.integers(-9, 9, len(g)), rng.random(len(g))))
    v[:3000][g[:3000] == 1] = 0.5
    v = np.append(v, [-np.inf, np.inf, 5e-324, -0.0])
    pdf = pd.DataFrame({"g": np.append(g, [4, 4, 4, 4]), "v": v})
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.5, 0.0, 0.001, 0.25, 0.26, 0.75, 0.999, 1.0]
    for by, groups in ((["g"], pdf.groupby("g")), ([], [(None, pdf)])):
        got = ranks.quantiles(df, "v", probs, by, [f"p{i}" for i in range(len(probs))]).toPandas()
        for key, sub in groups:
            row = got[got.g == key].iloc[0] if by else got.iloc[0]
            want = [np.quantile(sub.v, p) for p in probs]
            assert np.array_equal([row[f"p{i}"] for i in range(len(probs))], want) or np.allclose([row[f"p{i}"] for i in range(len(probs))], want, rtol=1e-12, equal_nan=True)
    few = pdf[pdf.g != 4]
    got = ranks.mad(df.filter("g <> 4"), "v", ["g"]).toPandas().set_index("g")
    for key, sub in few.groupby("g"):
        med = np.median(sub.v)
        assert got.loc[key, "median"] == med and got.loc[key, "mad"] == pytest.approx(1.4826 * np.median(np.abs(sub.v - med)))
    holes = df.withColumn("v", F.when((F.col("g") != 2) | (F.col("v") > 0), F.col("v"))).withColumn("v", F.when(F.col("g") != 1, F.col("v")))
    strict, known = (dict(ranks.median(holes, "v", ["g"], skip_nulls=skip).collect()) for skip in (False, True))
    assert strict[2] is None and strict[1] is None and known[1] is None and strict[3] == known[3] == np.median(few.v[few.g == 3])
    assert known[2] == np.median(few.v[(few.g == 2) & (few.v > 0)])


def test_statistics_of_money_and_stamps(spark):
    import datetime as dt
    import decimal

    money = [decimal.Decimal(x) for x in ("12345678901234.57", "12345678901234.56", "-0.01", "0.00", "12345678901234.57", "7.10")]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(money)], "k int, v decimal(18,2)")
    got = {r.k: r.v_rank for r in ranks.avg_rank(df, "v").collect()}
    assert [got[i] for i in range(6)] == pd.Series([float(m * 100) for m in money]).rank().tolist()
    assert ranks.median(df, "v").first()["median"] == pytest.approx((7.1 + 12345678901234.56) / 2)
    assert ranks.mad(df, "v").first()["median"] == pytest.approx((7.1 + 12345678901234.56) / 2)
    wide = df.select("k", (F.col("v").cast("decimal(38,2)") * 10 ** 15).cast("decimal(38,2)").alias("v"))
    assert {r.k: r.v_rank for r in ranks.avg_rank(wide, "v").collect()} == got
    stamps = [dt.datetime(1969, 7, 20), dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(2024, 3, 31, 2, 30), None, dt.datetime(2400, 12, 31)]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], f"k int, v {kind}")
        got = {r.k: r.v_rank for r in ranks.avg_rank(df, "v").collect()}
        assert got == {0: 1.0, 1: 3.0, 2: 2.0, 3: None, 4: 4.0}
    assert [r._pos for r in ranks.positions(df, [], ["v", "k"]).orderBy("k").collect()] == [0, 2, 1, 4, 3]


def test_ranges_spread_a_hot_group(spark):
    """One group holds all rows but ten, its keys are consecutive: no range has more than a few shares."""
    n = 4
    df = spark.range(20000).select((F.col("id") < 19990).alias("g"), (F.col("id") + 10 ** 12).alias("v"))
    borders = ranks._ranges(df, F.col("v"), n)
    rows = ranks.attach_row(df, borders).groupBy("g", ranks._range_of(F.col("v"), "_borders", n).alias("r")).count().collect()
    assert max(r["count"] for r in rows) < 2 * 20000 / n and len({r["r"] for r in rows}) == n


def test_robust_scale_and_zscore(skewed):
    df, pdf = skewed
    out = scale.robust_scale(df.select("k", "v"), ["v"]).toPandas().sort_values("k")
    med = np.median(pdf.v)
    mad = 1.4826 * np.median(np.abs(pdf.v - med))
    assert np.allclose(out.v, (pdf.sort_values("k").v - med) / mad)
    z = scale.zscore(df, "v", ["g"]).toPandas().sort_values("k")
    e = pdf.sort_values("k").groupby("g")["v"].transform(lambda s: (s - s.mean()) / s.std())
    assert np.allclose(z["z_v"].astype(float), e, equal_nan=True)   # one-row group: NULL


def test_skyline_brute_force(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"c": rng.integers(0, 3, 300), "cost": rng.integers(0, 40, 300),
                        "val": rng.integers(0, 40, 300), "id": np.arange(300)})
    got = set(verbs.skyline(spark.createDataFrame(pdf), ["c"], "cost", "val")
              .toPandas()["id"])
    exp = set()
    for r in pdf.itertuples():
        o = pdf[pdf.c == r.c]
        dom = ((o.cost <= r.cost) & (o.val >= r.val) & ((o.cost < r.cost) | (o.val > r.val))).any()
        if not dom:
            exp.add(r.id)
    assert got == exp


def test_histogram_fills_empty_bins(spark):
    df = spark.createDataFrame([(0.1,), (0.12,), (1.0,), (None,)], "x double")
    out = [tuple(r) for r in binning.histogram(df, "x", 0.25).orderBy("bin").collect()]
    assert [r[0] for r in out] == [0, 1, 2, 3, 4] and [r[-1] for r in out] == [2, 0, 0, 0, 1]


def test_boxplot_and_qq(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, x double")
    b = binning.boxplot(df, "x").first()
    assert (b.q1, b.median, b.q3) == (2.0, 3.0, 4.0) and b.ymax == 4.0 and b.n_outliers == 1
    qq = binning.qq_normal(df, "x", "k").orderBy("sample").toPandas()
    assert qq.theoretical.is_monotonic_increasing and qq.theoretical.iloc[2] == pytest.approx(0)


def test_sample_per_group_one_row_each(spark):
    from strataframe.operators.resample import sample_per_group, sample_n
    df = spark.range(100).select((F.col("id") % 7).alias("g"), F.col("id").alias("k"))
    s = sample_per_group(df, ["g"], 3, "k")
    assert s.count() == 7 and s.groupBy("g").count().filter("count > 1").count() == 0
    sn = sample_n(df, 30, 4, "k")
    assert sn.count() == 30 and sn.select("draw").distinct().count() == 30


def test_order_keys_of_every_type(spark):
    import datetime as dt
    import math

    rng = np.random.default_rng(0)
    doubles = [0.0, -0.0, 1.0, math.nextafter(1, 2), -1.0, 2.0, math.nextafter(2, 0), 5e-324, -5e-324, 2.0 ** -1022,
               math.nextafter(2.0 ** -1022, 0), 1.7976931348623157e308, math.inf, -math.inf]
    doubles += [2.0 ** k for k in range(-1074, 1024, 97)] + (rng.normal(size=200) * 10.0 ** rng.integers(-300, 300, 200)).tolist()
    longs = [0, -1, 1, (1 << 63) - 2, -(1 << 63), 1 << 42, -(1 << 42) - 1, 7, 7, 123456789012]
    days = [dt.date(1, 1, 1), dt.date(1969, 12, 31), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]
    for values, kind in ((doubles, "double"), (longs, "long"), ([5, -5, 0, 2**31 - 1, -2**31], "int"), (days, "date"), ([True, False], "boolean")):
        df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], f"v {kind}, k int")
        got = {r.k: r.v_rank for r in ranks.avg_rank(df, "v").collect()}
        want = pd.Series([v.toordinal() if isinstance(v, dt.date) else v for v in values]).rank()
        assert [got[k] for k in range(len(values))] == want.tolist(), kind
    with pytest.raises(TypeError):
        ranks.avg_rank(spark.createDataFrame([("a",)], "v string"), "v")


def test_running_sums_keep_their_type(spark):
    df = spark.createDataFrame([(0.6, k) for k in range(4)], "v double, k int")
    got = [r._before for r in ranks.running_before(df, [], ["k"], "v").orderBy("k").collect()]
    assert got == pytest.approx([0.0, 0.6, 1.2, 1.8])


def test_nothing_runs_while_a_plan_is_built(spark, skewed):
    from strataframe.operators import infer, ols, resample

    df, _ = skewed
    other = df.withColumn("w", F.col("v") + F.col("k") % 3)
    sc = spark.sparkContext
    sc.setJobGroup("plans", "plans")
    try:
        ranks.avg_rank(df, "v", ["g"]), ranks.mad(df, "v"), scale.robust_scale(df, ["v"]), scale.zscore(df, "v")
        binning.boxplot(df, "v", ["g"]), binning.histogram(df, "v", 1.0), binning.qq_normal(df, "v", "k", ["g"])
        infer.spearman(other, "v", "w"), verbs.skyline(df, ["g"], "v", "k"), verbs.top_n(df, 3, "v")
        resample.boot_corr(other, "v", "w", 3, 5, 1, "k"), ols.rss_grid(other, "v", "w", 0.5)
        ols.ols(other, "v", ["w"]).predict(other, se=True), ols.ols(other, "v", ["w"], ["g"]).tidy()
        assert list(sc.statusTracker().getJobIdsForGroup("plans")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_top_n_keeps_all_ties_without_one_partition(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("v"), F.col("id").alias("k"))
    top = verbs.top_n(df, 3, "v")
    assert top.count() == 500
    assert "Window" not in top._jdf.queryExecution().executedPlan().toString()
    by = verbs.top_n(df.withColumn("g", F.col("k") % 3), 1, "v", ["g"])
    assert by.count() == 500


def test_approx_median_close_to_exact(skewed):
    df, pdf = skewed
    approx = dict(ranks.median(df, "v", ["g"], approx=True).collect())
    for g, sub in pdf.groupby("g"):
        if len(sub) >= 40:   # a sketch value: an element within the rank error, no interpolation
            lo, hi = np.quantile(sub.v, [0.4, 0.6])
            assert lo <= approx[g] <= hi and approx[g] in set(sub.v)


def test_per_group_requires_a_schema(skewed):
    df, _ = skewed
    with pytest.raises(ValueError, match="schema"):
        verbs.per_group(df, ["g"], lambda pdf: pdf, "")


def test_histogram_of_only_nulls_is_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    out = binning.histogram(df, "x", 0.5)
    assert out.count() == 0 and out.columns == ["bin", "x", "xmin", "xmax", "count"]
