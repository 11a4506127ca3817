"""OLS, inference and the identities the analyses rely on."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.functions import dist
from strataframe.operators import infer
from strataframe.operators.ols import line, ols, rss_grid, slope_by
from tests.conftest import SF01


def test_exact_line_and_plane(spark):
    line_df = spark.createDataFrame([(float(x), 2 + 3.0 * x) for x in range(6)], "x double, y double")
    t = {r.term: r for r in ols(line_df, "y", ["x"]).tidy().collect()}
    assert t["(Intercept)"].estimate == pytest.approx(2) and t["x"].estimate == pytest.approx(3)
    assert t["x"].std_error == pytest.approx(0, abs=1e-9)
    plane = spark.createDataFrame([(float(a), float(b), 1 + 2.0 * a - 0.5 * b)
                                   for a in range(4) for b in range(3)],
                                  "x1 double, x2 double, y double")
    est = [r.estimate for r in ols(plane, "y", ["x1", "x2"]).tidy().collect()]
    assert est == pytest.approx([1, 2, -0.5])


def test_collinear_and_constant_predictors_are_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, 1.0), (2.0, 4.0, 8.0, 1.0), (3.0, 6.0, 11.5, 1.0),
                                (4.0, 8.0, 13.0, 1.0)], "x1 double, x2 double, y double, c double")
    t = {r.term: r.estimate for r in ols(df, "y", ["x1", "x2", "c"]).tidy().collect()}
    assert t["x1"] is not None and t["x2"] is None and t["c"] is None


def test_one_row_and_two_rows(spark):
    one = spark.createDataFrame([(1.0, 5.0)], "x double, y double")
    t = ols(one, "y", ["x"]).tidy().collect()
    assert t[0].estimate == 5.0 and t[0].std_error is None and t[1].estimate is None
    two = spark.createDataFrame([(1.0, 5.0), (2.0, 7.0)], "x double, y double")
    t = ols(two, "y", ["x"]).tidy().collect()
    assert t[1].estimate == pytest.approx(2.0) and t[1].std_error is None  # zero residual df


def test_null_rows_dropped_from_fit(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 100.0), (3.0, None), (4.0, 8.0)],
                               "x double, y double")
    assert ols(df, "y", ["x"]).glance().first().nobs == 3


def test_ols_matches_numpy_and_spark_ml(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from strataframe.plans.basics import team_rates
    d = team_rates(spark, SF01)
    xs = ["BB", "singles", "doubles", "triples", "HR"]
    fit = ols(d, "R", xs)
    t = fit.tidy(conf_int=True).toPandas()
    pdf = d.toPandas()
    X = np.column_stack([np.ones(len(pdf)), pdf[xs].to_numpy()])
    y = pdf["R"].to_numpy()
    b = np.linalg.lstsq(X, y, rcond=None)[0]
    res = y - X @ b
    s2 = res @ res / (len(y) - X.shape[1])
    se = np.sqrt(np.diag(s2 * np.linalg.inv(X.T @ X)))
    assert np.allclose(t.estimate, b) and np.allclose(t.std_error, se)
    m = LinearRegression(featuresCol="f", labelCol="R", solver="normal").fit(
        VectorAssembler(inputCols=xs, outputCol="f").transform(d))
    ml_p = list(m.summary.pValues)  # features first, intercept last
    assert np.allclose(t.p_value.iloc[1:], ml_p[:-1], atol=1e-9)
    g = fit.glance().first()
    assert g.r_squared == pytest.approx(m.summary.r2) and g.adj_r_squared == pytest.approx(
        m.summary.r2adj)
    q = dist.t_quantile(0.975, np.array([len(y) - 6.0]))[0]
    assert np.allclose(t.conf_low, b - q * se) and np.allclose(t.conf_high, b + q * se)


def test_distribution_tails_published_values():
    assert dist.t_quantile(0.975, np.array([1.0, 5.0, 30.0])) == pytest.approx(
        [12.7062047, 2.5705818, 2.0422725], rel=1e-6)
    assert dist.t_two_sided_p(np.array([2.0]), np.array([10.0]))[0] == pytest.approx(0.0733880, rel=1e-5)
    assert dist.f_upper_p(np.array([3.0]), np.array([2.0]), np.array([10.0]))[0] == pytest.approx(
        0.0953674, rel=1e-5)
    assert dist.chi2_1df_upper_p(np.array([3.841458820694124]))[0] == pytest.approx(0.05)


def test_slope_identities(spark):
    """cor·sd/sd equals the fitted slope; standardised slope equals r."""
    from strataframe.plans.basics import galton
    g = galton(spark, SF01)
    l = line(g, "father", "son").first()
    t = {r.term: r.estimate for r in ols(g, "son", ["father"]).tidy().collect()}
    assert l.slope == pytest.approx(t["father"]) and l.intercept == pytest.approx(t["(Intercept)"])
    zs = g.select(((F.col("father") - l.mu_x) / l.s_x).alias("zx"),
                  ((F.col("son") - l.mu_y) / l.s_y).alias("zy"))
    tz = {r.term: r.estimate for r in ols(zs, "zy", ["zx"]).tidy().collect()}
    assert tz["zx"] == pytest.approx(l.r) and tz["(Intercept)"] == pytest.approx(0, abs=1e-12)


def test_rss_grid_against_brute_force(spark):
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in
                                enumerate([(1, 2), (2, 2.5), (3, 4), (4, 4.1), (5, 6)])],
                               "k int, x double, y double")
    got = rss_grid(df, "x", "y", 0.5).toPandas().sort_values("beta1")
    pdf = df.toPandas()
    for _, r in got.iterrows():
        exp = ((pdf.y - 0.5 - r.beta1 * pdf.x) ** 2).sum()
        assert r.rss == pytest.approx(exp, rel=1e-12)
    assert list(got.beta1) == pytest.approx([0, 0.25, 0.5, 0.75, 1.0])


def test_predict_equals_augment(spark):
    from strataframe.plans.basics import galton
    g = galton(spark, SF01)
    fit = ols(g, "son", ["father"])
    p = fit.predict(g).select("child_id", "fitted")
    a = fit.augment(g).select("child_id", F.col("fitted").alias("f2"))
    diff = p.join(a, "child_id").agg(F.max(F.abs(F.col("fitted") - F.col("f2")))).first()[0]
    assert diff < 1e-9


def test_grouped_fit_and_slope_by(spark):
    df = spark.createDataFrame([(g, float(x), g * 1.0 + (g + 1.0) * x)
                                for g in range(3) for x in range(5)], "g int, x double, y double")
    t = {(r.g, r.term): r.estimate for r in ols(df, "y", ["x"], by=["g"]).tidy().collect()}
    for g in range(3):
        assert t[(g, "x")] == pytest.approx(g + 1) and t[(g, "(Intercept)")] == pytest.approx(g)
    s = dict((r.g, r.slope) for r in slope_by(df, "x", "y", ["g"]).collect())
    assert s[2] == pytest.approx(3.0)


def test_spearman_equals_pearson_of_ranks_with_ties(spark):
    import pandas as pd
    vals = [(i, float(i % 7), float((i * 3) % 11)) for i in range(60)]
    df = spark.createDataFrame(vals, "k int, x double, y double")
    got = infer.spearman(df, "x", "y").first().spearman
    pdf = pd.DataFrame(vals, columns=["k", "x", "y"])
    assert got == pytest.approx(pdf.x.rank().corr(pdf.y.rank()))


def test_chisq_2x2_yates(spark):
    # a 2x2 table with the classical Yates-corrected result computed by hand
    t = spark.createDataFrame([("a", 12, 5), ("b", 9, 14)], "g string, yes long, no long")
    r = infer.chisq_2x2(t, "yes", "no").first()
    obs = np.array([[12, 5], [9, 14]], float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    yc = min(0.5, np.abs(obs - e).min())
    stat = (((np.abs(obs - e) - yc) ** 2) / e).sum()
    assert r.statistic == pytest.approx(stat) and r.parameter == 1
    assert r.p_value == pytest.approx(dist.chi2_1df_upper_p(np.array([stat]))[0])
    eq = spark.createDataFrame([("a", 10, 10), ("b", 10, 10)], "g string, yes long, no long")
    assert infer.chisq_2x2(eq, "yes", "no").first().statistic == pytest.approx(0.0)


def test_bootstrap_mean_of_r_near_r(spark):
    from strataframe.operators.resample import boot_corr
    from strataframe.plans.basics import galton
    g = galton(spark, SF01)
    r = line(g, "father", "son").first().r
    br = boot_corr(g, "father", "son", 200, 50, 11, "child_id").agg(F.avg("r")).first()[0]
    assert abs(br - r) < 0.05


def test_anscombe_quartet_equal_fits(spark):
    """The four classical equal-correlation data sets (1973): same line, same r."""
    x = [10, 8, 13, 9, 11, 14, 6, 4, 12, 7, 5]
    ys = {1: [8.04, 6.95, 7.58, 8.81, 8.33, 9.96, 7.24, 4.26, 10.84, 4.82, 5.68],
          2: [9.14, 8.14, 8.74, 8.77, 9.26, 8.10, 6.13, 3.10, 9.13, 7.26, 4.74],
          3: [7.46, 6.77, 12.74, 7.11, 7.81, 8.84, 6.08, 5.39, 8.15, 6.42, 5.73]}
    x4 = [8, 8, 8, 8, 8, 8, 8, 19, 8, 8, 8]
    y4 = [6.58, 5.76, 7.71, 8.84, 8.47, 7.04, 5.25, 12.50, 5.56, 7.91, 6.89]
    data = [(s, float(a), b) for s, yy in ys.items() for a, b in zip(x, yy)]
    data += [(4, float(a), b) for a, b in zip(x4, y4)]
    df = spark.createDataFrame(data, "set int, x double, y double")
    out = line(df, "x", "y", ["set"]).collect()
    for r in out:
        assert r.slope == pytest.approx(0.5, abs=0.002) and r.r == pytest.approx(0.816, abs=0.001)


def test_squares_of_consecutive_days_are_not_aliased(spark):
    from strataframe.operators.ols import ols

    df = spark.createDataFrame([(float(d), float(d) ** 2, 3.0 + (d % 5)) for d in range(19800, 19831)], "x double, x2 double, y double")
    assert all(r.estimate is not None for r in ols(df, "y", ["x", "x2"]).tidy().collect())
    twice = df.withColumn("x2", F.col("x") * 2)
    assert sum(r.estimate is None for r in ols(twice, "y", ["x", "x2"]).tidy().collect()) == 1


def test_tails_hold_for_many_degrees_of_freedom():
    import math

    from strataframe.functions import dist

    for df in (1e5, 0.99e7, 1.01e7, 1e10, 1e12):
        for t in (0.01, 1.96, 5.0):
            assert float(dist.t_two_sided_p(t, df)) == pytest.approx(math.erfc(t / math.sqrt(2)), rel=200 / df + 1e-9)
        assert float(dist.t_quantile(0.975, np.array([df]))[0]) == pytest.approx(1.959963984540054, rel=3 / df + 1e-9)
    assert float(dist.f_upper_p(3.0, 2, 10)) == pytest.approx((10 / 16) ** 5)
