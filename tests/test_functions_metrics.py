"""Edge rules of the column expressions and the forecast metrics (the
reference's literal-array unit cases plus the edge cases in its metric code)."""

import math

import pytest
import numpy as np
from pyspark.sql import functions as F

from paneltide.functions import exprs as X
from paneltide.operators import metrics as mt


def test_treatment_columns_never_null(spark):
    df = spark.createDataFrame([(2015, 2016), (2016, 2016), (2020, 2016), (2020, None)],
                               "year int, ev int")
    r = df.select(X.treated("year", "ev").alias("t"), X.years_since("year", "ev").alias("s")).collect()
    assert [x.t for x in r] == [False, True, True, False]
    assert [x.s for x in r] == [0, 0, 4, 0]


@pytest.mark.parametrize("years,t0,expected", [
    ([2010, 2015, 2016, 2020], 2016, [0, 0, 1, 1]),
    ([2008, 2009, 2010, 2011], 2010, [0, 0, 1, 1]),
])
def test_post_dummy(spark, years, t0, expected):
    df = spark.createDataFrame([(y,) for y in years], "year int")
    assert [r[0] for r in df.select(X.post_dummy("year", t0)).collect()] == expected


def test_share_null_unless_total_positive(spark):
    df = spark.createDataFrame([(5.0, 10.0), (1.0, 0.0), (1.0, None), (None, 4.0)], "p double, t double")
    assert [r[0] for r in df.select(X.share("p", "t")).collect()] == [0.5, None, None, None]


def test_trend_label_null_is_stable(spark):
    df = spark.createDataFrame([(11.0,), (-11.0,), (10.0,), (None,)], "p double")
    assert [r[0] for r in df.select(X.trend_label("p")).collect()] == [
        "high_growth", "high_decline", "stable", "stable"]


def test_parse_codes(spark):
    r = spark.range(1).select(X.parse_codes(" usa, chn ,,ind ,")).first()[0]
    assert r == ["USA", "CHN", "IND"]


def test_verdict_and_direction(spark):
    df = spark.createDataFrame([(-2.0, -1.0, 1.0, 1.5), (1.0, 2.0, 5.0, 1.0), (-1.0, 1.0, 3.0, 9.0)],
                               "lo double, hi double, a double, b double")
    r = df.select(X.verdict("lo", "hi"), X.direction_label("a", "b")).collect()
    assert [x[0] for x in r] == ["reduces", "increases", "inconclusive"]
    assert [x[1] for x in r] == ["flat", "down", "up"]


def test_safe_div_under_ansi(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (6.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(X.safe_div("a", "b")).collect()] == [None, None, 2.0]


def _metrics(spark, y, f):
    rows = [("k", i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, f))]
    df = spark.createDataFrame(rows, "key string, step int, y double, forecast double")
    return mt.mase_smape(df, "key", "step").first()


def test_mase_perfect_and_naive(spark):
    r = _metrics(spark, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5])
    assert r.mase == 0.0 and r.smape == 0.0
    r = _metrics(spark, [1, 2, 3, 4, 5], [0, 1, 2, 3, 4])
    assert abs(r.mase - 1.0) < 1e-10


def test_smape_bounds_and_value(spark):
    r = _metrics(spark, [1, 2, 3], [3, 1, 5])
    expected = 100.0 / 3 * (2 * 2 / 4 + 2 * 1 / 3 + 2 * 2 / 8)
    assert abs(r.smape - expected) < 1e-10
    assert 0 <= r.smape <= 200


def test_metric_edges(spark):
    assert math.isinf(_metrics(spark, [3, 3, 3], [1, 1, 1]).mase)        # constant series, error > 0
    assert _metrics(spark, [3, 3, 3], [3, 3, 3]).mase == 0.0              # constant, no error
    assert math.isnan(_metrics(spark, [3], [1]).mase)                     # one point
    assert _metrics(spark, [0, 0], [0, 0]).smape == 0.0                   # all zero
    # a zero-denominator point adds 0 but counts in n
    r = _metrics(spark, [0, 2], [0, 1])
    assert abs(r.smape - 100.0 / 2 * (2 * 1 / 3)) < 1e-10


def test_macro_avg_skips_non_finite(spark):
    df = spark.createDataFrame([("a", 1.0, 10.0), ("b", float("inf"), 20.0), ("c", float("nan"), 30.0)],
                               "key string, mase double, smape double")
    r = mt.macro_avg(df.withColumn("g", F.lit(1)), ["g"]).first()
    assert r.mase == 1.0 and r.smape == 10.0 and r.n_keys == 1   # a key counts when all its scores are finite


def test_segments_take_their_own_shares(spark):
    df = spark.createDataFrame([(f"k{i}", float(i)) for i in range(10)], "k string, total double")
    for top, bottom, high, low in ((0.2, 0.4, 2, 4), (0.3, 0.2, 3, 2), (0.2, 0.2, 2, 2)):
        seg = [r.segment for r in mt.segments(df, "k", "total", top, bottom).orderBy(F.desc("total")).collect()]
        assert seg == ["high"] * high + ["mid"] * (10 - high - low) + ["low"] * low


def test_scale_any_factor(spark):
    from paneltide.functions.exprs import scale

    for factor in (0.75, 0.4, 1e-3, 1e-6, 2.5):
        got = spark.createDataFrame([(100.0,)], "x double").select(scale("x", factor)).first()[0]
        assert abs(got - 100 * factor) < 1e-9


def test_empty_inputs_do_not_raise(spark):
    from paneltide.operators import aggregates as agg
    from paneltide.operators import forecast as fc

    df = spark.createDataFrame([], "k string, year int, y double, w long")
    assert all(r.null_pct is None for r in agg.null_profile(df).collect())
    assert agg.weighted_moments(df, ["y"], "w").first()["mean"] is None
    one = spark.createDataFrame([("a", 2000, 1.0), ("b", 2000, 1.0), ("b", 2001, 3.0)], "k string, year int, y double")
    got = {r.k: r.forecast for r in fc.forecast(one, "k", "year", "y", 1, "drift", unit="year").collect()}
    assert got == {"a": None, "b": 5.0}


def test_weighted_moments_of_small_and_large_values(spark):
    from paneltide.operators import aggregates as agg

    df = spark.createDataFrame([(v, v * 1e20, 1) for v in (0.0, 0.001, 0.002, 0.003, 0.004)], "a double, b double, w long")
    got = {r.feature: r for r in agg.weighted_moments(df, ["a", "b"], "w").collect()}
    assert abs(got["a"].mean - 0.002) < 1e-15 and abs(got["a"]["std"] - 0.002 ** 0.5 * 0.002 ** 0.5 * 0.5 ** 0.5) < 1e-12
    assert abs(got["b"].mean / 2e17 - 1) < 1e-12


def test_weighted_moments_far_from_zero(spark):
    """The spread survives whatever the values' size, and any partitioning."""
    from paneltide.operators import aggregates as agg

    rng = np.random.default_rng(8)
    rows = [(1e9 + v, float(x), None if v == 2 else float(v), w) for v, x, w in zip([0, 1, 2, 3, 4] * 200, rng.normal(1e6, 1e-3, 1000), rng.integers(0, 4, 1000).tolist())]
    df = spark.createDataFrame(rows, "a double, b double, c double, w long")
    same = df.withColumn("w", F.lit(1))
    for parts in (1, 7, 50):
        got = {r.feature: r for r in agg.weighted_moments(same.repartition(parts), ["a"], "w").collect()}
        assert abs(got["a"]["std"] - 2**0.5) < 1e-7 and abs(got["a"]["mean"] - 1e9 - 2) < 1e-5
        got = {r.feature: r for r in agg.weighted_moments(df.repartition(parts), ["a", "b", "c"], "w").collect()}
        for k, f in enumerate("abc"):
            x, w = np.array([(r[k], r[3]) for r in rows if r[k] is not None]).T
            mean = np.average(x, weights=w)
            std = np.average((x - mean) ** 2, weights=w) ** 0.5
            assert abs(got[f]["mean"] / mean - 1) < 1e-12 and abs(got[f]["std"] / std - 1) < 1e-6
    one = spark.createDataFrame([(5.0, 3), (None, 2)], "a double, w long")
    assert agg.weighted_moments(one, ["a"], "w").first()["std"] == 0.0
    assert agg.weighted_moments(one.where("a is null"), ["a"], "w").first()["mean"] is None
