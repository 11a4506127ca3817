"""NULL, rounding, division, tie and reshape rules on tiny literal tables (FIXTURES Part C)."""

import math

import pytest
from pyspark.sql import functions as F

from strataframe.functions.columns import (
    norm_ppf, normal, remove_first, rnd, safe_corr, safe_div, slope_moments, strict, text_or_na,
    uniform,
)
from strataframe.operators import aggs, reshape, verbs


def rows(df, order=None):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_strict_aggregate_null_propagates(spark):
    df = spark.createDataFrame([(1, 1.0), (1, None), (2, 2.0), (2, 4.0)], "g int, x double")
    out = rows(df.groupBy("g").agg(strict(F.avg("x"), "x").alias("m")), ["g"])
    assert out == [(1, None), (2, 3.0)]


def test_safe_corr_constant_one_row_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 5.0), (2, 1.0, 1.0), (3, 1.0, 2.0),
                                (3, 2.0, None), (3, 3.0, 4.0)], "g int, x double, y double")
    out = dict(rows(df.groupBy("g").agg(safe_corr("x", "y").alias("r"))))
    assert out[1] is None and out[2] is None and out[3] is None   # constant, n=1, NULL
    skip = dict(rows(df.groupBy("g").agg(safe_corr("x", "y", skip_nulls=True).alias("r"))))
    assert skip[3] == pytest.approx(1.0)


def test_slope_null_for_constant_response(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)], "x double, y double")
    assert df.agg(slope_moments("x", "y")).first()[0] is None


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r[0] for r in df.select(rnd("x", 0)).collect()] == [0.0, 2.0, 2.0, -0.0]


def test_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (4, 2)], "a int, b int")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, 2.0]


def test_first_per_group_ties_and_top_n_ties(spark):
    df = spark.createDataFrame([(1, 5, 2), (1, 5, 1), (1, 3, 0), (2, None, 9), (2, 1, 8)],
                               "g int, v int, k int")
    first = rows(verbs.first_per_group(df, ["g"], "v", "k"), ["g"])
    assert first == [(1, 5, 1), (2, 1, 8)]
    top = rows(verbs.top_n(df, 1, "v"), ["k"])
    assert top == [(1, 5, 1), (1, 5, 2)]          # both ties kept, NULL dropped


def test_argmax_cols_first_index_on_ties(spark):
    df = spark.createDataFrame([(3, 3, 1), (1, 2, 2), (None, 1, 0)], "a int, b int, c int")
    got = [r[0] for r in df.select(verbs.argmax_cols(["a", "b", "c"])).collect()]
    assert got == ["a", "b", "b"]


def test_spread_duplicate_raises_and_missing_is_null(spark):
    ok = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0)],
                               "id int, k string, v double")
    assert rows(reshape.spread(ok, ["id"], "k", "v", ["a", "b"]), ["id"]) == \
        [(1, 1.0, 2.0), (2, 3.0, None)]
    dup = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0)], "id int, k string, v double")
    with pytest.raises(Exception, match="duplicate"):
        reshape.spread(dup, ["id"], "k", "v", ["a"]).collect()


def test_unite_writes_na_and_remove_first(spark):
    df = spark.createDataFrame([("x", None), ("G_1b", "y")], "a string, b string")
    assert [r[0] for r in reshape.unite(df, "u", ["a", "b"]).collect()] == ["x_NA", "G_1b_y"]
    assert df.select(remove_first(F.lit("G_xG_y"), "G_")).first()[0] == "xG_y"
    assert df.select(text_or_na(F.lit(None).cast("int"))).first()[0] == "NA"


def test_unparsable_date_is_null(spark):
    df = spark.createDataFrame([("2001-02-03",), ("not a date",)], "s string")
    got = [r[0] for r in df.select(F.try_to_date("s")).collect()]
    assert str(got[0]) == "2001-02-03" and got[1] is None


def test_gather_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "id int, a double, b double")
    assert rows(reshape.gather(df, ["id"], ["a", "b"], "k", "v"), ["k"]) == \
        [(1, "a", 1.0), (1, "b", None)]


def test_crosstab_missing_cell_zero(spark):
    df = spark.createDataFrame([("r1", "c1"), ("r1", "c1"), ("r2", "c2")], "r string, c string")
    assert rows(aggs.crosstab(df, "r", "c", ["c1", "c2"]), ["r"]) == [("r1", 2, 0), ("r2", 0, 1)]


def test_hash_draws_are_deterministic_and_uniform(spark):
    df = spark.range(20000)
    u = df.select(uniform(7, "id").alias("u"), normal(7, "id").alias("z"))
    s = u.agg(F.min("u"), F.max("u"), F.avg("u"), F.avg("z"), F.stddev("z")).first()
    assert 0 < s[0] < 0.001 and 0.999 < s[1] < 1
    assert abs(s[2] - 0.5) < 0.01 and abs(s[3]) < 0.03 and abs(s[4] - 1) < 0.03
    assert rows(u.limit(5)) == rows(df.select(uniform(7, "id"), normal(7, "id")).limit(5))


def test_norm_ppf_matches_inverse_cdf(spark):
    ps = [0.001, 0.02, 0.3, 0.5, 0.9, 0.99, 0.9999]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r[0] for r in df.select(norm_ppf("p")).collect()]
    for p, z in zip(ps, got):
        assert 0.5 * math.erfc(-z / math.sqrt(2)) == pytest.approx(p, rel=1e-8)


def test_event_time_independent_of_session_time_zone(spark):
    from strataframe.sources.fixtures import events_xy
    from tests.conftest import SF001
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        t_la = events_xy(spark, SF001).orderBy("event_id").first().time
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert t_la == events_xy(spark, SF001).orderBy("event_id").first().time


# ---------------------------------------------------------------- NULL keys are a group
KEYED = "g int, x double, y double, k int"


@pytest.fixture(scope="module")
def keyed(spark):
    data = [(1 if k % 2 else None, float(k % 17), float((k * 7) % 23), k) for k in range(200)]
    same = [(1 if k % 2 else 2, x, y, k) for k, (_, x, y, _) in enumerate(data)]
    return spark.createDataFrame(data, KEYED), spark.createDataFrame(same, KEYED)


def _by_forms():
    from strataframe.operators import binning, infer, ols, ranks, scale

    by = ["g"]
    return {
        "zscore": lambda d: scale.zscore(d, "x", by), "robust_scale": lambda d: scale.robust_scale(d, ["x", "y"], by),
        "share_of_total": lambda d: scale.share_of_total(d, "x", "s", by), "avg_rank": lambda d: ranks.avg_rank(d, "x", by),
        "quantiles": lambda d: ranks.quantiles(d, "x", [0.1, 0.9], by), "mad": lambda d: ranks.mad(d, "x", by),
        "positions": lambda d: ranks.positions(d, by, ["x", "k"]), "spearman": lambda d: infer.spearman(d, "x", "y", by),
        "filter_group": lambda d: verbs.filter_group(d, by, [F.count("*").alias("_n")], F.col("_n") > 5),
        "label_extreme": lambda d: verbs.label_extreme(d, by, "x", "l", "min", "other"),
        "first_per_group": lambda d: verbs.first_per_group(d, by, "x", "k"), "top_n": lambda d: verbs.top_n(d, 3, "x", by),
        "histogram": lambda d: binning.histogram(d, "x", 5.0, by), "boxplot": lambda d: binning.boxplot(d, "x", by),
        "box_outliers": lambda d: binning.box_outliers(d, "x", by), "qq_normal": lambda d: binning.qq_normal(d, "x", "k", by),
        "smooth_lm": lambda d: binning.smooth_lm(d, "x", "y", by, 5), "skyline": lambda d: verbs.skyline(d, by, "x", "y"),
        "predict": lambda d: ols.ols(d, "y", ["x"], by).predict(d, se=True), "tidy": lambda d: ols.ols(d, "y", ["x"], by).tidy(),
        "augment": lambda d: ols.ols(d, "y", ["x"], by).augment(d), "line": lambda d: ols.line(d, "x", "y", by),
        "corr_matrix": lambda d: aggs.corr_matrix(d, ["x", "y"], by),
        "semi_join": lambda d: verbs.semi_join(d, d.filter("x > 3"), by), "left_join": lambda d: verbs.left_join(d, d.groupBy("g").count(), by),
        "right_join": lambda d: verbs.right_join(d.groupBy("g").count(), d, by),
    }


@pytest.mark.parametrize("form", sorted(_by_forms()))
def test_a_null_key_is_a_group_like_any_other(keyed, form):
    """The same rows with key 2 in place of NULL give the same result."""
    null, plain = (_by_forms()[form](d) for d in keyed)
    assert null.columns == plain.columns
    show = lambda v: f"{v:.10g}" if isinstance(v, float) else v
    text = lambda rs, none: sorted(repr(tuple(none if v is None and c == "g" else show(v) for c, v in r.asDict().items())) for r in rs)
    assert text(null.collect(), 2) == text(plain.collect(), 2)


def test_joins_match_null_keys_unless_asked_not_to(spark):
    a = spark.createDataFrame([(None, 1), (1, 2)], "k int, a int")
    b = spark.createDataFrame([(None, 5), (2, 6)], "k int, b int")
    assert sorted(rows(verbs.left_join(a, b, ["k"])), key=repr) == [(1, 2, None), (None, 1, 5)]
    assert sorted(rows(verbs.right_join(a, b, ["k"])), key=repr) == [(2, None, 6), (None, 1, 5)]
    assert rows(verbs.join_suffix(a, b, ["k"])) == [(None, 1, 5)]
    assert sorted(rows(verbs.left_join(a, b, ["k"], null_matches=False)), key=repr) == [(1, 2, None), (None, 1, None)]


def test_weighted_mean_and_share_with_nulls(spark):
    df = spark.createDataFrame([(10.0, 1.0, True), (None, 9.0, None)], "x double, w double, p boolean")
    agg = lambda c: df.agg(c).first()[0]
    assert agg(aggs.weighted_mean("x", "w")) is None and agg(aggs.weighted_mean("x", "w", skip_nulls=True)) == 10.0
    assert agg(aggs.share(F.col("p"), "w")) is None and agg(aggs.share(F.col("p"), "w", skip_nulls=True)) == 100.0


def test_scales_and_medians_are_strict(spark):
    from strataframe.operators import ranks, scale

    df = spark.createDataFrame([(1, 1.0), (1, None), (1, 3.0), (2, 1.0), (2, 3.0)], "g int, x double")
    assert dict(rows(ranks.median(df, "x", ["g"]))) == {1: None, 2: 2.0}
    assert dict(rows(ranks.median(df, "x", ["g"], skip_nulls=True))) == {1: 2.0, 2: 2.0}
    for out in (scale.zscore(df, "x", ["g"], "z"), scale.share_of_total(df, "x", "z", ["g"])):
        assert all((r.z is None) == (r.g == 1) for r in out.collect())
    assert [r.x for r in scale.robust_scale(df, ["x"], ["g"]).filter("g = 1").collect()] == [None] * 3


def test_first_per_group_of_dates_text_and_nulls_only(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "c", 2), (1, "c", 0), (2, None, 5), (2, None, 4)], "g int, v string, k int")
    assert rows(verbs.first_per_group(df, ["g"], "v", "k"), ["g"]) == [(1, "c", 0), (2, None, 4)]
    assert rows(verbs.first_per_group(df, ["g"], "v", "k", descending=False), ["g"]) == [(1, "b", 1), (2, None, 4)]
    dates = df.withColumn("v", F.date_add(F.lit("2020-01-01").cast("date"), F.col("k")))
    assert [r.k for r in verbs.first_per_group(dates, ["g"], "v", "k").orderBy("g").collect()] == [2, 5]


def test_exclude_row_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(1,), (23,), (None,)], "k int")
    assert sorted(rows(verbs.exclude_row(df, "k", 23)), key=repr) == [(1,), (None,)]


def test_remove_first_of_alternatives(spark):
    assert spark.range(1).select(remove_first(F.lit("xbxa"), "a|b")).first()[0] == "xxa"


def test_chi_square_takes_two_rows_only(spark):
    from strataframe.operators import infer

    for n in (1, 3):
        df = spark.createDataFrame([(5.0 + k, 7.0) for k in range(n)], "a double, b double")
        with pytest.raises(Exception, match="two rows"):
            infer.chisq_2x2(df, "a", "b").collect()


def test_attach_row_rejects_more_rows(spark):
    from strataframe.operators.attach import attach_row, count_up

    df = spark.range(3)
    with pytest.raises(Exception, match="at most one row"):
        attach_row(df, spark.range(2).withColumnRenamed("id", "x")).collect()
    assert {r.x for r in attach_row(df, spark.range(0).withColumnRenamed("id", "x")).collect()} == {None}
    far = spark.createDataFrame([(-2, 3_000_000)], "a long, b long")
    assert tuple(count_up(far, "a", "b", "n").agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()) == (-2, 3_000_000, 3_000_003)


def test_relative_rounding_keeps_small_numbers(spark):
    from strataframe.plans.registry import round_double

    values = [1.23456789123e-7, 4.4e-10, 123456.7891234, -2.5e18, 0.0, -0.0, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(round_double(F.col("x"))).collect()]
    assert got == [1.2346e-7, 4.4e-10, 123456.789, -2.5e18, 0.0, 0.0, None]


def test_checkpoint_folder(spark, monkeypatch, tmp_path):
    from strataframe import session

    class Context:
        def __init__(self, master, conf, now):
            self.master, self.conf, self.now = master, conf, now

        def getConf(self):
            return self.conf

        def getCheckpointDir(self):
            return self.now

        def setCheckpointDir(self, d):
            self.now = d

    class Session:
        def __init__(self, *a):
            self.sparkContext = Context(*a)

    named = Session("spark://x", {"spark.checkpoint.dir": "hdfs://shared"}, None)
    assert session.checkpoint_dir(named) == "hdfs://shared" and named.sparkContext.now == "hdfs://shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session("spark://x", {}, None))
    local = Session("local[2]", {}, None)
    assert session.checkpoint_dir(local) == local.sparkContext.now
