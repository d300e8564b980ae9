"""Forecasts, CV+ intervals, fixed-effects estimators, cohort ATT, double ML
and the anomaly scorers against brute-force numpy / pandas versions on small
fixtures (these have no SQL twin)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paneltide.operators import anomaly as an
from paneltide.operators import causal as cz
from paneltide.operators import forecast as fc


def _series(spark, n_keys=3, n=23, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n_keys):
        y = 100 + 3 * k * np.arange(n) + rng.normal(0, 5, n).round(2)
        rows += [(f"k{k}", 2000 + t, float(y[t])) for t in range(n)]
    return spark.createDataFrame(rows, "k string, year int, y double"), rows


def test_forecast_methods_match_numpy(spark):
    df, rows = _series(spark)
    pdf = pd.DataFrame(rows, columns=["k", "year", "y"])
    h = 4
    for method in ["naive", "drift", "trend"]:
        got = {(r.k, r.step): r.forecast for r in fc.forecast(df, "k", "year", "y", h, method, unit="year").collect()}
        for k, g in pdf.groupby("k"):
            y = g.sort_values("year")["y"].to_numpy()
            n = len(y)
            for s in range(1, h + 1):
                if method == "naive":
                    ref = y[-1]
                elif method == "drift":
                    ref = y[-1] + s * (y[-1] - y[0]) / (n - 1)
                else:
                    b, a = np.polyfit(np.arange(n), y, 1)
                    ref = a + b * (n - 1 + s)
                assert abs(got[(k, s)] - ref) < 1e-6


def test_forecast_several_methods_in_one_pass(spark):
    df, _ = _series(spark)
    methods = ["naive", "drift", "trend"]
    cols = ["k", "step", "year", "forecast", "method", "direction"]
    both = fc.forecast(df, "k", "year", "y", 4, methods, unit="year").select(*cols).collect()
    single = [r for m in methods
              for r in fc.forecast(df, "k", "year", "y", 4, m, unit="year").select(*cols).collect()]
    assert sorted(map(tuple, both)) == sorted(map(tuple, single))
    assert len(both) == 3 * 3 * 4


def test_cv_plus_matches_brute_force(spark):
    df, rows = _series(spark, n_keys=2, n=23)
    h, alpha, kf = 3, 0.1, 5
    got = {(r.k, r.step): (r.lower, r.upper) for r in fc.cv_plus(df, "k", "year", "y", h, alpha, kf, unit="year").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "year", "y"])
    for k, g in pdf.groupby("k"):
        y = g.sort_values("year")["y"].to_numpy()
        n = len(y)
        t = np.arange(n)
        folds = np.array_split(t, kf)  # contiguous, first folds longer
        fold_of = np.concatenate([[i] * len(f) for i, f in enumerate(folds)])
        fits = []
        for i in range(kf):
            m = fold_of != i
            fits.append(np.polyfit(t[m], y[m], 1))
        r = np.array([abs(y[j] - np.polyval(fits[fold_of[j]], t[j])) for j in range(n)])
        for s in range(1, h + 1):
            x = n - 1 + s
            mu = np.array([np.polyval(fits[fold_of[j]], x) for j in range(n)])
            lo = np.sort(mu - r)[int(math.floor(alpha * (n + 1))) - 1]
            hi = np.sort(mu + r)[int(math.ceil((1 - alpha) * (n + 1))) - 1]
            assert abs(got[(k, s)][0] - lo) < 1e-6 and abs(got[(k, s)][1] - hi) < 1e-6
            assert got[(k, s)][0] <= got[(k, s)][1]


def _panel(balanced=True, seed=3, units=12, periods=8, effect=2.5):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(units):
        ev = 2003 + (u % 3) if u % 4 else None
        for p in range(periods):
            year = 2000 + p
            if not balanced and (u + p) % 5 == 0:
                continue
            x = rng.normal()
            d = 1.0 if ev is not None and year >= ev else 0.0
            y = 1.5 * u + 0.7 * p + effect * d + 0.8 * x + rng.normal(0, 0.3)
            rows.append((f"u{u}", year, y, d, x, ev))
    return rows


def _dense_fe(rows, controls=True, time_effects=True):
    """OLS with explicit unit (and time) dummies, CRV1 by unit."""
    pdf = pd.DataFrame(rows, columns=["u", "year", "y", "d", "x", "ev"])
    X = [pdf["d"].to_numpy()] + ([pdf["x"].to_numpy()] if controls else [])
    k = len(X)
    U = pd.get_dummies(pdf["u"]).to_numpy(float)
    mats = [np.column_stack(X), U]
    if time_effects:
        mats.append(pd.get_dummies(pdf["year"]).to_numpy(float)[:, 1:])
    Z = np.column_stack(mats)
    beta, *_ = np.linalg.lstsq(Z, pdf["y"].to_numpy(), rcond=None)
    e = pdf["y"].to_numpy() - Z @ beta
    # CRV1 for the first k coefficients via the Frisch-Waugh partialled X
    P = np.column_stack(mats[1:])
    Xt = np.column_stack(X) - P @ np.linalg.lstsq(P, np.column_stack(X), rcond=None)[0]
    inv = np.linalg.inv(Xt.T @ Xt)
    meat = np.zeros((k, k))
    for _, idx in pdf.groupby("u").groups.items():
        s = Xt[idx].T @ e[idx]
        meat += np.outer(s, s)
    g, n = pdf["u"].nunique(), len(pdf)
    cov = g / (g - 1) * (n - 1) / (n - k) * inv @ meat @ inv
    return beta[0], math.sqrt(cov[0, 0])


@pytest.mark.parametrize("balanced,controls,dense_periods,tol", [
    (True, False, cz.DENSE_PERIODS, 1e-9),
    (False, True, cz.DENSE_PERIODS, 1e-9),   # the time effects' matrix
    (False, True, 0, 1e-7),                  # conjugate gradients over grouped passes
])
def test_twfe_matches_dense_dummies(spark, balanced, controls, dense_periods, tol):
    rows = _panel(balanced)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.twfe(df, "y", "d", ["x"] if controls else [], "u", "year", estimator="t",
                dense_periods=dense_periods).first()
    att, se = _dense_fe(rows, controls)
    assert r.status == "ok"
    assert abs(r.att - att) < tol and abs(r.se - se) < tol


def test_exact_two_way_demeaning_matches_projection(spark):
    """Disconnected and ragged panel: the exact path equals the residual of a
    dense projection on unit and period dummies, column by column."""
    rng = np.random.default_rng(11)
    rows = [(f"u{u}", 2000 + p, float(rng.normal()), float(rng.normal()))
            for u in range(9) for p in range(7) if rng.random() < 0.7 or p == u % 7]
    df = spark.createDataFrame(rows, "u string, year int, a double, b double")
    shape = cz.panel_shape(df, "u", "year")
    assert not shape["balanced"]
    got, ok = cz.demean(df, ["a", "b"], "u", "year", shape=shape)
    assert ok
    got = got.toPandas()
    pdf = pd.DataFrame(rows, columns=["u", "year", "a", "b"])
    Z = np.column_stack([pd.get_dummies(pdf["u"]).to_numpy(float), pd.get_dummies(pdf["year"]).to_numpy(float)])
    m = pdf.merge(got, on=["u", "year"], suffixes=("", "_dm"))
    for c in ["a", "b"]:
        y = m[c].to_numpy()
        resid = y - Z[m.index] @ np.linalg.lstsq(Z[m.index], y, rcond=None)[0]
        assert np.abs(m[f"{c}_dm"].to_numpy() - resid).max() < 1e-9


def _chain(units=1796 // 2, periods=450):
    """Every unit is seen in two neighbouring periods: period effects hang
    together in one long chain."""
    rng = np.random.default_rng(2)
    rows = []
    for u in range(units):
        p = u % (periods - 1)
        for q in (p, p + 1):
            d = float(rng.random() < 0.5)
            rows.append((f"u{u}", 1000 + q, float(2.0 * d + 0.1 * u % 7 + np.sin(q) * 5 + rng.normal(0, 0.5)), d, float(rng.normal()), None))
    return rows


def test_chain_panel_is_solved_exactly(spark):
    rows = _chain()
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.twfe(df, "y", "d", [], "u", "year").first()
    att, se = _dense_fe(rows, controls=False)
    assert r.status == "ok" and abs(r.att - att) < 1e-7 and abs(r.se - se) < 1e-7


def test_conjugate_gradients_on_a_chain():
    """Far more steps than any fixed cap would allow, on the chain's system."""
    n = 450
    a = np.diag(np.r_[0.5, np.ones(n - 2), 0.5]) - 0.5 * (np.eye(n, k=1) + np.eye(n, k=-1))
    b = a @ np.random.default_rng(0).normal(size=(n, 2))
    x, ok = cz._conjugate_gradients(lambda v: a @ v, np.diag(a).copy(), b)
    assert ok and np.abs(a @ x - b).max() < 1e-9


def test_stalled_solution_is_reported(spark, monkeypatch):
    monkeypatch.setattr(cz, "_conjugate_gradients", lambda apply, diag, b: (np.zeros_like(b), False))
    rows = _panel(False)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.twfe(df, "y", "d", ["x"], "u", "year", dense_periods=0).first()
    assert r.status == "not_converged" and r.att is None
    r = cz.twfe(df, "y", "d", ["x"], "u", "year", dense_periods=0, fallback=True).first()
    att, _ = _dense_fe(rows, controls=False, time_effects=False)
    assert r.estimator == "twfe_unit_fallback" and abs(r.att - att) < 1e-9


def test_unit_fe_matches_dense(spark):
    rows = _panel(False)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.twfe(df, "y", "d", [], "u", "year", time_effects=False).first()
    att, se = _dense_fe(rows, controls=False, time_effects=False)
    assert abs(r.att - att) < 1e-6 and abs(r.se - se) < 1e-6


def test_uniform_post_dummy_is_collinear(spark):
    rows = _panel(True)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    df = df.withColumn("post", cz.post_dummy_col("year", 2004).cast("double"))
    r = cz.twfe(df, "y", "post", [], "u", "year").first()
    assert r.status == "collinear" and r.att is None


def test_placebo_pre_period_only(spark):
    rows = _panel(True, effect=5.0)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.placebo(df, "y", "u", "year", "ev", shift=2).first()
    assert r.status == "ok" and abs(r.att) < 1.0   # no real effect leaks into the placebo
    assert r.n_obs < len(rows)


def test_cohort_att_matches_pandas(spark):
    rows = _panel(True)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    got = {(r.cohort, r.year): r.att for r in cz.cohort_att(df, "u", "year", "y", "ev").collect()}
    pdf = pd.DataFrame(rows, columns=["u", "year", "y", "d", "x", "ev"])
    cell = pdf.groupby([pdf["ev"].fillna(-1), "year"])["y"].mean()
    for g in sorted(pdf["ev"].dropna().unique()):
        for t in sorted(pdf["year"].unique()):
            if t == g - 1:
                continue
            ref = (cell[(g, t)] - cell[(g, g - 1)]) - (cell[(-1, t)] - cell[(-1, g - 1)])
            assert abs(got[(int(g), int(t))] - ref) < 1e-9


def test_placebo_with_controls_and_fake_year(spark):
    rows = _panel(True, effect=5.0)
    df = spark.createDataFrame(rows, "u string, year int, y double, d double, x double, ev int")
    r = cz.placebo(df, "y", "u", "year", "ev", controls=["x"], fake_year=2002).first()
    pre = [(u, t, y, float(ev is not None and t >= 2002), x, ev) for u, t, y, _, x, ev in rows if ev is None or t < ev]
    att, se = _dense_fe(pre)
    assert abs(r.att - att) < 1e-7 and abs(r.se - se) < 1e-7


def test_cohort_without_base_period_is_reported(spark):
    rows = [("a", t, 1.0 * t, 2000) for t in (2000, 2001)] + [("b", t, 2.0 * t, 2002) for t in (2000, 2001, 2002)]
    rows += [("n", t, 1.0, None) for t in (2000, 2001)]
    df = spark.createDataFrame(rows, "u string, t int, y double, ev int")
    got = {(r.cohort, r.t): (r.att, r.status) for r in cz.cohort_att(df, "u", "t", "y", "ev").collect()}
    assert got[(2000, 2001)] == (None, "no_base_period") and got[(2002, 2002)] == (None, "no_never_treated")
    assert got[(2002, 2000)][1] == "ok"


def test_double_ml_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [(f"u{u}", float(rng.normal()), float(rng.random() < 0.5), float(rng.normal()), float(rng.normal())) for u in range(40) for _ in range(5)]
    df = spark.createDataFrame(rows, "u string, y double, d double, x1 double, x2 double")
    got = [cz.double_ml(df.repartition(n), "y", "d", ["x1", "x2"], "u").first().ate for n in (4, 7, 13)]
    assert max(got) - min(got) < 1e-8


def test_double_ml_recovers_effect(spark):
    rng = np.random.default_rng(11)
    rows = []
    for u in range(60):
        for p in range(6):
            x1, x2 = rng.normal(), rng.normal()
            d = float(0.8 * x1 + rng.normal() > 0)
            y = 3.0 * d + 2.0 * x1 - 1.0 * x2 + rng.normal(0, 0.5)
            rows.append((f"u{u}", y, d, x1, x2))
    df = spark.createDataFrame(rows, "u string, y double, d double, x1 double, x2 double")
    r = cz.double_ml(df, "y", "d", ["x1", "x2"], "u").first()
    assert r.status == "ok" and abs(r.ate - 3.0) < 0.4 and r.ci_lower < r.ate < r.ci_upper


def test_zscore_and_flags(spark):
    df = spark.createDataFrame([("a", t, float(t), 1.0) for t in range(20)] + [("a", 20, 100.0, 1.0)],
                               "k string, t int, v double, c double")
    stats = an.standardize_stats(df, ["v", "c"])
    z = an.zscore(df, stats, ["v", "c"]).collect()
    assert all(r.z_c == 0.0 for r in z)               # zero std -> divided by 1
    scores = an.zscore(df, stats, ["v"]).withColumn("score", F.col("z_v") ** 2)
    flagged = an.flag_top(scores, "k", "score", 0.05)
    thr = np.percentile([r.score for r in scores.collect()], 95)
    got = flagged.collect()
    assert abs(got[0].threshold - thr) < 1e-9
    assert {r.t for r in got if r.is_anomaly} == {20}


def test_anomaly_feed_labels(spark):
    df = spark.createDataFrame([("a", 1996, 1.0), ("a", 1997, 9.0), ("a", 1998, 1.5)], "k string, year int, s double")
    out = {r.year: (r.event_label, r.total_anomalies) for r in an.anomaly_feed(df, "k", "year", "s", 0.2).collect()}
    assert out[1997][0] == "Asian Financial Crisis" and out[1996][0] == ""
    assert all(v[1] == 1 for v in out.values())


def test_isolation_forest_and_pca_flag_outlier(spark):
    rng = np.random.default_rng(5)
    rows = [("a", t, float(rng.normal()), float(rng.normal())) for t in range(60)]
    rows[30] = ("a", 30, 25.0, -25.0)
    df = spark.createDataFrame(rows, "k string, t int, x double, z double")
    res = an.isolation_forest(df, "k", "t", ["x", "z"], contamination=0.05).collect()
    top = max(res, key=lambda r: r.iforest_score)
    assert top.t == 30 and top.is_anomaly
    from paneltide.operators.windows import sequences
    seqs = sequences(df, "k", "t", ["x", "z"], 3)
    err = an.pca_recon_error(seqs, "k", "start", "seq", d=6, k=1).collect()
    worst = max(err, key=lambda r: r.recon_error)
    assert 28 <= worst.start <= 30


def test_recon_error_matches_numpy(spark):
    from paneltide.operators.windows import sequences

    rng = np.random.default_rng(6)
    rows = [(k, t, float(rng.normal()), float(rng.normal(0, 3))) for k in ("a", "b") for t in range(40)]
    df = spark.createDataFrame(rows, "k string, t int, x double, z double")
    seqs = sequences(df, "k", "t", ["x", "z"], 3, step="end")
    got = {(r.k, r.end): r.recon_error for r in an.pca_recon_error(seqs, "k", "start", "seq", d=6, k=2, fit_before=30, step="end").collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "x", "z"])
    wins = {(k, t): g[["x", "z"]].to_numpy()[t - 2: t + 1].ravel() for k, g in pdf.groupby("k") for t in range(2, 40)}
    train = np.array([v for (k, t), v in wins.items() if t < 30])
    axes = np.linalg.svd(train - train.mean(0))[2][:2]
    assert set(got) == set(wins)
    for key, v in wins.items():
        c = v - train.mean(0)
        assert abs(got[key] - ((c - c @ axes.T @ axes) ** 2).mean()) < 1e-9
    assert an.pca_recon_error(seqs.where("false"), "k", "start", "seq", d=6, k=2).count() == 0


def plain_forest(drawn, kh, limit):
    """One tree at a time, row by row, from the same draws and split numbers."""
    from paneltide.operators.isolation import uniform, unresolved_depth

    def build(tree, rows, node, level):
        col = int(uniform(kh, tree, node, 1) * len(rows[0]))
        values = [r[col] for r in rows]
        low, high = min(values), max(values)
        if len(rows) <= 1 or low == high or level >= limit:
            return level + float(unresolved_depth(len(rows)))
        cut = max(high - float(uniform(kh, tree, node, 2)) * (high - low), np.nextafter(low, high))
        return col, cut, build(tree, [r for r in rows if r[col] < cut], 2 * node + 1, level + 1), build(tree, [r for r in rows if r[col] >= cut], 2 * node + 2, level + 1)

    trees = [build(tree, rows, 0, 0) for tree, rows in sorted(drawn.items())]

    def depth(node, x):
        while isinstance(node, tuple):
            node = node[2] if x[node[0]] < node[1] else node[3]
        return node

    return lambda x: sum(depth(tree, x) for tree in trees) / len(trees)


def test_isolation_forest_against_a_plain_forest(spark):
    from paneltide.operators import isolation

    rng = np.random.default_rng(3)
    rows = [("a", t, float(rng.normal()), float(rng.normal())) for t in range(1500)] + [("b", t, float(rng.normal()), 1.0) for t in range(40)]
    rows += [(None, 1, 0.0, None), ("b", 3, rows[1503][2], 1.0), ("c", 5, 2.0, 2.0), ("c", 5, 2.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, t int, x double, z double")
    got = isolation.forest_scores(df, "k", "t", ["x", "z"], n_trees=20, sample=64).collect()
    assert len(got) == len(rows)
    panel = isolation.panel_rows(df, "k", "t", ["x", "z"])
    drawn = {}
    for r in isolation.draws(panel, 20, 64, 42).collect():
        for tree in range(20) if r.tree < 0 else [r.tree]:
            drawn.setdefault((r.k, r.kh), {}).setdefault(tree, []).append(list(r.x))
    at = {(r[0], r[1]): [v or 0.0 for v in r[2:]] for r in rows}
    for (k, kh), trees in drawn.items():
        n = len({t for kk, t in at if kk == k})
        psi = min(n, 64)
        assert len(trees) == 20 and all(len(held) == psi for held in trees.values())
        depth = plain_forest(trees, kh, isolation.height(psi))
        c = max(float(isolation.unresolved_depth(psi)), 1e-12)
        for r in got:
            if r.k == k:
                assert abs(r.iforest_score - 2.0 ** (-depth(at[k, r.t]) / c)) < 1e-12


def test_isolation_forest_draws_all_of_a_large_key(spark):
    """Every row of a key can be drawn; trees draw for themselves; partitions,
    chunks and repeated rows change nothing."""
    from paneltide.operators import isolation

    df = spark.range(30_000).selectExpr("'a' AS k", "id AS t", "cast(id % 997 AS double) AS x", "cast(hash(id) AS double) AS z")
    panel = isolation.panel_rows(df, "k", "t", ["x", "z"])
    per = isolation.draws(panel, 100, 256, 1).groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct("x").alias("d")).collect()
    assert len(per) == 100 and all(r.n == 256 and r.d == 256 for r in per)
    seen = isolation.draws(panel, 100, 256, 1).select("x").distinct().count()
    assert 16_500 < seen < 17_900  # 30,000 (1 - (1 - 256 / 30,000) ** 100) = 17,254 are expected
    small = df.where("t < 700")
    one = {r.t: r.iforest_score for r in isolation.forest_scores(small, "k", "t", ["x", "z"], n_trees=20).collect()}
    two = isolation.forest_scores(small.union(small.where("t < 9")).repartition(7), "k", "t", ["x", "z"], n_trees=20).collect()
    assert len(two) == 709 and {r.t: r.iforest_score for r in two} == one and all(0 < v < 1 for v in one.values())
    assert isolation.forest_scores(small.where("false"), "k", "t", ["x", "z"]).count() == 0


def test_isolation_forest_moves_and_keeps_no_forests(spark):
    """Forests are grown where rows are scored: those of 400 small keys would
    take 50 MB at once, and none crosses a shuffle."""
    import tracemalloc

    import pyarrow as pa

    from paneltide.operators import isolation

    df = spark.range(12_000).selectExpr("id div 30 AS k", "id AS t", "cast(hash(id) AS double) AS x")
    out = isolation.forest_scores(df, "k", "t", ["x"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "nodes" not in plan
    rows = [{"k": k, "kh": 7 * k, "n": 30, "rows": [{"t": t, "m": 1, "x": [float((k * 31 + t * t) % 101)]} for t in range(30)], "held": None} for k in range(400)]
    held = pa.list_(pa.struct([("tree", pa.int32()), ("x", pa.list_(pa.float64()))]))
    parts = pa.list_(pa.struct([("t", pa.int64()), ("m", pa.int64()), ("x", pa.list_(pa.float64()))]))
    kinds = pa.schema([("k", pa.int64()), ("kh", pa.int64()), ("n", pa.int64()), ("rows", parts), ("held", held)])
    batch = pa.RecordBatch.from_pylist(rows, kinds)
    sizes, grow = [], isolation.grow
    isolation.grow = lambda *a: sizes.append((g := grow(*a)).size) or g
    try:
        tracemalloc.start()
        got = sum(b.num_rows for b in isolation._scorer(100, 1, 256)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        isolation.grow = grow
    assert got == 12_000 and len(sizes) > 2 and max(sizes) <= isolation.GROWN and peak < 250e6


def test_isolation_forest_around_the_sample_size(spark):
    """Keys of as many rows as a tree draws, and one more, next to small ones;
    a sample larger than a chunk."""
    from paneltide.operators import isolation

    df = spark.range(64 + 65 + 3).selectExpr("case when id < 64 then 1 when id < 129 then 2 else 3 end AS k", "id AS t", "cast(hash(id) AS double) AS x")
    got = isolation.forest_scores(df, "k", "t", ["x"], n_trees=5, sample=64).collect()
    alone = [r for k in (1, 2, 3) for r in isolation.forest_scores(df.where(f"k = {k}"), "k", "t", ["x"], n_trees=5, sample=64).collect()]
    assert len(got) == 132 and sorted(got) == sorted(alone)
    large = spark.range(5000).selectExpr("1 AS k", "id AS t", "cast(hash(id) AS double) AS x")
    assert len({r.iforest_score for r in isolation.forest_scores(large, "k", "t", ["x"], n_trees=2, sample=6000).collect()}) > 100


def test_kth_of_shifted_lists(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        lists = [(float(rng.integers(-5, 5)), sorted(float(v) for v in rng.integers(0, 9, rng.integers(0, 12)))) for _ in range(rng.integers(1, 6))]
        total = sum(len(v) for _, v in lists)
        rows += [(i, m, lists) for m in {0, 1, total // 2, total, total + 1}]
    df = spark.createDataFrame(rows, "i int, m int, f array<struct<at:double,values:array<double>>>")
    powers = F.lit([16, 8, 4, 2, 1])
    got = df.select("i", "m", "f", fc.kth_of_lists(F.col("f"), powers, F.col("m")).alias("v")).collect()
    for r in got:
        union = sorted(at + v for at, values in r.f for v in values)
        assert r.v == (union[r.m - 1] if 1 <= r.m <= len(union) else None)


def test_cv_plus_makes_no_row_for_a_point_and_step(spark):
    df = spark.createDataFrame([("a", t, float(t % 7)) for t in range(40)] + [("b", 1, 1.0), ("c", 1, 1.0), ("c", 2, 3.0)], "k string, year int, y double")
    out = fc.cv_plus(df, "k", "year", "y", 500, unit="year")
    got = {(r.k, r.step): (r.lower, r.upper) for r in out.collect()}
    assert len(got) == 1500 and got["b", 1] == (None, None) and got["c", 3] == (None, None) and all(lo < hi for (k, _), (lo, hi) in got.items() if k == "a")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("step" in line for line in plan.splitlines() if "Window [" in line or "Sort [" in line)


def test_cohort_errors_match_a_dense_regression(spark):
    """Standard errors per cell and overall against the saturated regression
    on cell dummies with CRV1 by unit; units miss some periods."""
    rng = np.random.default_rng(9)
    rows = []
    for u in range(30):
        ev = [None, 2003, 2004, 2006][u % 4]
        level = rng.normal(0, 3)
        rows += [(f"u{u}", t, float(level + rng.normal() + (2.0 if ev and t >= ev else 0.0)), ev) for t in range(2000, 2009) if rng.random() > 0.1]
    df = spark.createDataFrame(rows + [("u0", 2008, None, None)], "u string, t int, y double, ev int")
    pdf = pd.DataFrame(rows, columns=["u", "t", "y", "ev"])
    pdf["ev"] = pdf["ev"].fillna(-1).astype(int)
    cells = sorted(set(zip(pdf.ev, pdf.t)))
    x = np.zeros((len(pdf), len(cells)))
    x[np.arange(len(pdf)), [cells.index(c) for c in zip(pdf.ev, pdf.t)]] = 1
    inv = np.linalg.inv(x.T @ x)
    beta = inv @ x.T @ pdf.y.to_numpy()
    e = pdf.y.to_numpy() - x @ beta
    scores = np.array([x[(pdf.u == u).to_numpy()].T @ e[(pdf.u == u).to_numpy()] for u in pdf.u.unique()])
    g, n, k = len(scores), len(pdf), len(cells)
    cov = g / (g - 1) * (n - 1) / (n - k) * inv @ scores.T @ scores @ inv

    def contrast(ev, t):
        c = np.zeros(k)
        for cell, sign in (((ev, t), 1), ((ev, ev - 1), -1), ((-1, t), -1), ((-1, ev - 1), 1)):
            c[cells.index(cell)] += sign
        return c

    got = cz.cohort_att(df, "u", "t", "y", "ev").collect()
    assert len(got) == 24 and all(r.status == "ok" for r in got)
    total, weight = np.zeros(k), 0
    for r in got:
        c = contrast(r.cohort, r.t)
        assert abs(r.att - c @ beta) < 1e-9 and abs(r.se - np.sqrt(c @ cov @ c)) < 1e-9
        assert abs(r.ci_upper - r.att - 1.96 * r.se) < 1e-9 and abs(r.att - r.ci_lower - 1.96 * r.se) < 1e-9
        if r.t >= r.cohort:
            total, weight = total + r.n_units * c, weight + r.n_units
    one = cz.cohort_att_overall(df, "u", "t", "y", "ev").first()
    total /= weight
    assert abs(one.att - total @ beta) < 1e-9 and abs(one.se - np.sqrt(total @ cov @ total)) < 1e-9 and one.n_unit_periods == weight
    none = cz.cohort_att_overall(df.where("ev is null"), "u", "t", "y", "ev").first()
    assert none.att is None and none.se is None and none.n_cells == 0


def test_comoments_far_from_zero(spark):
    from paneltide.operators.comoments import comoments

    rng = np.random.default_rng(10)
    x = rng.normal(size=(900, 4)) @ rng.normal(size=(4, 4)) + np.array([1e9, -1e7, 0.0, 5.0])
    g = rng.integers(0, 3, 900)
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(g, x)], "g int, x array<double>")
    for parts in (1, 9):
        got = comoments(df.repartition(parts), F.col("x"), F.col("g"), 4)
        assert set(got) == {0, 1, 2}
        for k, (n, mean, c) in got.items():
            own = x[g == k]
            assert n == len(own) and np.allclose(mean, own.mean(0), rtol=1e-14)
            assert np.allclose(c / n, np.cov(own.T, bias=True), atol=1e-5) and abs(c[2, 3] / n - np.cov(own.T, bias=True)[2, 3]) < 1e-10
    assert comoments(df.where("false"), F.col("x"), F.col("g"), 4) == {}


def test_lasso_agrees_with_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from paneltide.operators import lasso
    from paneltide.operators.comoments import comoments

    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 4)) * [1.0, 5.0, 0.2, 0.0] + [0.0, 30.0, -2.0, 7.0]
    x[:, 2] += 0.3 * x[:, 0]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, e double, y double")
    vectors = VectorAssembler(inputCols=["a", "b", "c", "e"], outputCol="v").transform(df)
    state = comoments(df, F.array("a", "b", "c", "e", "y"), F.lit(0), 5)[0]
    for penalty in (1e-4, 1e-2, 0.5, 5.0):
        m = LinearRegression(featuresCol="v", labelCol="y", elasticNetParam=1.0, regParam=penalty, solver="normal", tol=1e-14, maxIter=2000).fit(vectors)
        coefficients, intercept = lasso.fit(state, [0, 1, 2, 3], 4, penalty)
        assert np.allclose(coefficients, m.coefficients.toArray(), atol=1e-8) and abs(intercept - m.intercept) < 1e-7
        want = ((y - x @ coefficients - intercept) ** 2).mean()
        assert abs(lasso.error(state, [0, 1, 2, 3], 4, coefficients, intercept) - want) < 1e-9
    # at the optimum no column is correlated with the residual beyond the penalty
    coefficients, intercept = lasso.fit(state, [0, 1, 2, 3], 4, 0.5)
    score = ((x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)).T @ (y - x @ coefficients - intercept) / 400
    assert (np.abs(score) <= 0.5 + 1e-9).all()


def test_double_ml_matches_a_dense_computation(spark):
    """The same folds, with each lasso's residuals and the final stage in numpy."""
    from paneltide.operators import lasso

    rng = np.random.default_rng(12)
    rows = [(f"u{u}", float(rng.normal()), float(rng.random() < 0.5), float(rng.normal(50, 2)), float(rng.normal())) for u in range(60) for _ in range(4)]
    rows = [(u, 2.0 * d + 0.5 * a - b + y, d, a, b) for u, y, d, a, b in rows] + [("gone", None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "u string, y double, d double, x1 double, x2 double")
    got = cz.double_ml(df, "y", "d", ["x1", "x2"], "u").first()
    marked = df.dropna().select("y", "d", "x1", "x2", (cz.unit_hash("u", 42) % 2).alias("f"), (cz.unit_hash("u", 43) % 4).alias("v")).toPandas().to_numpy(float)
    m, f, held = marked[:, [2, 3, 0, 1]], marked[:, 4], marked[:, 5] == 0

    def state(rows):
        return len(rows), rows.mean(0), (rows - rows.mean(0)).T @ (rows - rows.mean(0))

    res = np.zeros((len(m), 2))
    for k in (0, 1):
        for i, target in enumerate((2, 3)):
            tries = [lasso.fit(state(m[(f != k) & ~held]), [0, 1], target, p) for p in cz.PENALTIES]
            out = m[(f != k) & held]
            errors = [((out[:, target] - out[:, :2] @ b - c) ** 2).mean() for b, c in tries]
            b, c = lasso.fit(state(m[f != k]), [0, 1], target, cz.PENALTIES[int(np.argmin(errors))])
            res[f == k, i] = m[f == k, target] - m[f == k, :2] @ b - c
    z = np.column_stack([res[:, 1], res[:, 1:] * (m[:, :2] - m[:, :2].mean(0))])
    inv = np.linalg.inv(z.T @ z)
    theta = inv @ z.T @ res[:, 0]
    e = res[:, 0] - z @ theta
    se = np.sqrt((inv @ (z * e[:, None] ** 2).T @ z @ inv)[0, 0])
    assert got.n_obs == 240 and abs(got.ate - theta[0]) < 1e-9 and abs((got.ci_upper - got.ate) / 1.96 - se) < 1e-9


def test_recon_error_of_wide_windows(spark):
    """400 dimensions: no expression per matrix entry."""
    rng = np.random.default_rng(13)
    x = rng.normal(size=(300, 3)) @ rng.normal(size=(3, 400)) + 0.01 * rng.normal(size=(300, 400))
    x[17, 5] += 9.0
    df = spark.createDataFrame([("a", t, [float(v) for v in r]) for t, r in enumerate(x)] + [("a", 300, [None] * 400)], "k string, t int, v array<double>")
    out = an.pca_recon_error(df, "k", "t", "v", d=400, k=3)
    got = {r.t: r.recon_error for r in out.collect()}
    c = x - x.mean(0)
    axes = np.linalg.svd(c)[2][:3]
    want = ((c - c @ axes.T @ axes) ** 2).mean(1)
    assert got.pop(300) is None and np.allclose([got[t] for t in range(300)], want, rtol=1e-6) and max(got, key=got.get) == 17


def test_panel_forecast_leaves_short_series_out(spark):
    rows = [("a", 2000 + t, 3.0 * t) for t in range(8)] + [("b", 2000 + t, 1.0) for t in range(4)] + [("c", 2000 + t, None if t > 3 else 2.0 * t) for t in range(8)]
    df = spark.createDataFrame(rows, "k string, year int, y double")
    got = fc.panel_forecast(df, "k", "year", "y", 3, min_points=5, alpha=0.25).collect()
    assert {(r.k, r.year, r.direction) for r in got} == {("a", y, "up") for y in (2008, 2009, 2010)}
    assert all(abs(r.forecast - 3.0 * (r.year - 2000)) < 1e-9 and abs(r.lower - r.forecast) < 1e-6 and abs(r.upper - r.forecast) < 1e-6 for r in got)
