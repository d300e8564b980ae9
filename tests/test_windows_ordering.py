"""Window operators and the distributed global ordering, against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneltide.operators import ordering as od
from paneltide.operators import selection as sl
from paneltide.operators import windows as win


def test_ffill_leading_gap_is_zero(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 1, 7.0), ("b", 2, None)],
                               "k string, t int, y double")
    r = {(x.k, x.t): x.y for x in win.ffill(df, "k", "t", ["y"]).collect()}
    assert r == {("a", 1): 0.0, ("a", 2): 5.0, ("a", 3): 5.0, ("b", 1): 7.0, ("b", 2): 7.0}


def test_sequences_full_windows_only(spark):
    df = spark.createDataFrame([("a", t, float(t), float(10 * t)) for t in range(7)], "k string, t int, x double, z double")
    s = win.sequences(df, "k", "t", ["x", "z"], 3).orderBy("start").collect()
    assert len(s) == 5
    assert s[0].seq == [0.0, 0.0, 1.0, 10.0, 2.0, 20.0]


def test_window_weights_match_explosion(spark):
    n, w = 7, 3
    df = spark.createDataFrame([("a", t) for t in range(n)] + [("b", t) for t in range(2)], "k string, t int")
    got = {(r.k, r.t): r.weight for r in win.window_weights(df, "k", "t", w).collect()}
    for t in range(n):
        assert got[("a", t)] == sum(1 for s in range(n - w + 1) if s <= t < s + w)
    assert got[("b", 0)] == 0 and got[("b", 1)] == 0


def test_folds_match_contiguous_kfold(spark):
    df = spark.createDataFrame([("a", t) for t in range(63)], "k string, t int")
    sizes = [r["count"] for r in win.folds(df, "k", "t", 5).groupBy("fold").count().orderBy("fold").collect()]
    assert sizes == [13, 13, 13, 12, 12]


def test_holdout_last_h(spark):
    df = spark.createDataFrame([("a", t) for t in range(10)] + [("b", t) for t in range(3)], "k string, t int")
    out = win.holdout(df, "k", "t", 4)
    valid = {(r.k, r.t) for r in out.where("split = 'valid'").collect()}
    assert valid == {("a", 6), ("a", 7), ("a", 8), ("a", 9), ("b", 0), ("b", 1), ("b", 2)}


def test_dedup_latest_and_deterministic(spark):
    df = spark.createDataFrame([("a", 1, "2024-01-01", 1.0), ("a", 1, "2024-01-02", 2.0),
                                ("a", 1, "2024-01-02", 3.0), ("b", 1, "2024-01-01", 4.0)],
                               "k string, t int, at string, v double")
    got = {(r.k, r.t): r.v for r in win.dedup(df, ["k", "t"], ["at"], keep="last").collect()}
    assert got == {("a", 1): 3.0, ("b", 1): 4.0}
    first = {(r.k, r.t): r.v for r in win.dedup(df, ["k", "t"], ["at"], keep="first").collect()}
    assert first == {("a", 1): 1.0, ("b", 1): 4.0}


def test_yoy_bridges_gaps_and_guards_zero(spark):
    df = spark.createDataFrame([("a", 2000, 0.0), ("a", 2002, 5.0), ("a", 2003, 10.0)], "k string, y int, m double")
    r = {x.y: (x.m_prev_year, x.m_yoy_pct) for x in win.yoy(df, "k", "y", "m").collect()}
    assert r[2000] == (None, None)
    assert r[2002] == (0.0, None)
    assert r[2003] == (5.0, 100.0)


def test_future_steps(spark):
    df = spark.createDataFrame([("a", 2000), ("a", 2003), ("b", 1999)], "k string, year int")
    got = sorted((r.k, r.step, r.year) for r in win.future_steps(df, "k", "year", 2).collect())
    assert got == [("a", 1, 2004), ("a", 2, 2005), ("b", 1, 2000), ("b", 2, 2001)]


def test_global_positions_and_running_total(spark):
    rng = np.random.default_rng(1)
    vals = rng.integers(0, 50, 300)  # many ties, broken by the key
    df = spark.createDataFrame([(f"k{i:03d}", int(v)) for i, v in enumerate(vals)], "k string, v long")
    df = df.repartition(7)
    # keep the range partitions apart (AQE would merge them on data this
    # small), so the per-partition offsets are really exercised
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        out = od.global_positions(df, [F.col("v").desc(), F.col("k")], "rank", value_col="v", cum_col="cum",
                                  total_col="n").toPandas()
        parts = df.orderBy(F.col("v").desc(), F.col("k")).select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set(conf, "true")
    assert parts > 1
    assert (out["n"] == 300).all()
    ref = pd.DataFrame({"k": [f"k{i:03d}" for i in range(300)], "v": vals}).sort_values(
        ["v", "k"], ascending=[False, True]).reset_index(drop=True)
    ref["rank"] = np.arange(1, 301)
    ref["cum"] = ref["v"].cumsum()
    m = out.merge(ref, on="k", suffixes=("", "_ref"))
    assert (m["rank"] == m["rank_ref"]).all() and (m["cum"] == m["cum_ref"]).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=1001)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = {r.prob: r.value for r in sl.exact_quantiles(df, "x", probs).collect()}
    assert sorted(got) == probs
    for p, v in got.items():
        assert abs(v - np.percentile(x, p * 100)) < 1e-12


def test_half_of_the_values_equal(spark):
    """A value that half the rows share is one row of the sorted table."""
    x = np.concatenate([np.zeros(1000), np.random.default_rng(1).normal(size=1000)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    got = {r.prob: r.value for r in sl.exact_quantiles(df, "x", [0.1, 0.5, 0.9]).collect()}
    assert all(abs(v - np.percentile(x, p * 100)) < 1e-12 for p, v in got.items())
    sizes = df.groupBy("x").count().orderBy("x").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert sum(r["count"] for r in sizes) == 1001


def test_exact_quantiles_of_nothing_is_empty(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert sl.exact_quantiles(df, "x", [0.5]).count() == 0


def test_ntile_expression_matches_sql(spark):
    for n in [1, 4, 5, 7, 23]:
        df = spark.range(n).select((F.col("id") + 1).alias("pos"), F.lit(n).cast("long").alias("n"))
        got = [r[0] for r in df.orderBy("pos").select(od.ntile_expr(F.col("pos"), F.col("n"), 5)).collect()]
        ref = [r[0] for r in spark.range(n).selectExpr("ntile(5) OVER (ORDER BY id)").collect()]
        assert got == ref


def _hot_key_scores(spark):
    rng = np.random.default_rng(5)
    rows = [("hot", i, float(rng.integers(0, 40))) for i in range(600)]          # a third of the rows, many ties
    rows += [(f"k{i % 30}", i, float(rng.normal())) for i in range(1140)]
    rows += [(None, i, float(rng.normal())) for i in range(50)]                   # NULL key: one group
    rows += [("k1", 5000 + i, None) for i in range(10)]                           # NULL scores ignored
    rows += [("only_null", 1, None)]
    return spark.createDataFrame(rows, "k string, t int, s double").repartition(9), rows


def test_keyed_quantile_matches_numpy_on_a_hot_key(spark):
    df, rows = _hot_key_scores(spark)
    got = {r.k: r.value for r in od.keyed_quantile(df, "k", "s", 0.95).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "s"]).dropna(subset=["s"])
    pdf["k"] = pdf["k"].fillna("<null>")
    ref = {k: np.percentile(g["s"].to_numpy(), 95) for k, g in pdf.groupby("k")}
    assert {("<null>" if k is None else k) for k in got} == set(ref)
    for k, v in got.items():
        assert abs(v - ref["<null>" if k is None else k]) < 1e-12


def test_flag_top_paths_agree(spark):
    from paneltide.operators import anomaly as an

    df, _ = _hot_key_scores(spark)
    cols = ["k", "t", "s", "threshold", "is_anomaly"]
    small = sorted(map(tuple, an.flag_top(df, "k", "s", 0.05).select(*cols).collect()), key=repr)
    big = sorted(map(tuple, an.flag_top(df, "k", "s", 0.05, series=False).select(*cols).collect()),
                 key=repr)
    assert len(small) == len(big) == 1801
    for a, b in zip(small, big):
        assert a[:3] == b[:3] and a[4] == b[4]
        assert (a[3] is None and b[3] is None) or abs(a[3] - b[3]) < 1e-12


def test_keyed_positions_number_each_key_across_partitions(spark):
    df, rows = _hot_key_scores(spark)
    vals = df.where(F.col("s").isNotNull())
    order = [F.col("s"), F.col("t")]
    # keep the range partitions apart (AQE would merge them on data this
    # small), so the hot key really spans several tasks
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        spread = (vals.orderBy(F.col("k"), *order).where(F.col("k") == "hot")
                  .select(F.spark_partition_id()).distinct().count())
        pdf = od.keyed_positions(vals, "k", order, "pos").toPandas()
    finally:
        spark.conf.set(conf, "true")
    assert spread > 1
    pdf["k"] = pdf["k"].fillna("<null>")
    for k, g in pdf.groupby("k"):
        assert sorted(g["pos"]) == list(range(1, len(g) + 1))
        ordered = g.sort_values("pos")
        assert list(zip(ordered["s"], ordered["t"])) == sorted(zip(g["s"], g["t"]))


@pytest.mark.parametrize("held,accuracy", [(100_000, 10_000), (50, 10_000), (400, 60)])
def test_selection_by_narrowing_brackets(spark, monkeypatch, held, accuracy):
    """Few rows held and a poor sketch take more passes, not other values."""
    monkeypatch.setattr(sl, "HELD", held)
    monkeypatch.setattr(sl, "ACCURACY", accuracy)
    rng = np.random.default_rng(2)
    values = np.r_[rng.normal(size=3000), np.full(2500, 0.25), rng.pareto(0.3, 2000), [-1e300, 1e300, -np.inf, np.inf]]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 7, "x double").repartition(5)
    places = [0, 1, 2, 1500, 3000, 3500, 5400, 7400, 7502, 7503, 9999]
    n, got = sl.select(df, "x", lambda n: places)
    assert n == 7504 and got == {p: sorted(values)[p] for p in places if p < n}
    ints = df.where("x is not null").select(F.floor(F.least(F.greatest("x", F.lit(-9.0)), F.lit(9.0))).cast("int").alias("x"))
    assert sl.select(ints, "x", lambda n: [0, n // 2, n - 1])[1] == {p: sorted(int(np.floor(np.clip(v, -9, 9))) for v in values)[p] for p in (0, 3752, 7503)}
    two = spark.createDataFrame([(float(k % 2),) for k in range(1000)], "x double")  # the place lies between two heavy values
    assert sl.select(two, "x", lambda n: [499, 500])[1] == {499: 0.0, 500: 1.0}
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (2.0,)] + [(float("nan"),)] * 200, "x double")
    first = sl.select(nan, "x", lambda n: [0, 1, 2])[1]
    assert first[0] == 1.0 and first[1] == 2.0 and np.isnan(first[2])


def test_describe_moves_no_rows(spark):
    from paneltide.operators import aggregates as agg

    df = spark.range(1000).selectExpr("cast(id as double) x")
    got = {r.stat: r.value for r in agg.describe(df, "x").collect()}
    assert (got["q25"], got["q50"], got["q75"]) == (249.75, 499.5, 749.25)
    plan = agg.describe(df, "x")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Sort" not in plan
