"""Registered queries: time-series windows (W5-W10), forecasts (M1-M3),
metrics (A12-A17), z-scores and anomaly flags (M4, M6, M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneltide.functions.exprs import money, to_ds
from paneltide.operators import aggregates as agg
from paneltide.operators import anomaly as an
from paneltide.operators import filters as flt
from paneltide.operators import forecast as fc
from paneltide.operators import metrics as mt
from paneltide.operators import windows as win
from paneltide.operators.joins import align
from paneltide.plans import proxy
from paneltide.plans.catalog import cte, register
from paneltide.plans.queries import gold, staged

W = 3                 # sliding window length (days)
FEATS = ["y_ffill", "n", "err"]
H = 6                 # forecast horizon / hold-out (months)
K_FOLDS, ALPHA = 5, 0.1
MIN_POINTS = 78
FUTURE_YEARS = 5
CUTOFF_YEAR = 1999
CUTOFF_DAY = "2024-01-21"   # statistics and fits use the days before it
CONTAMINATION = 0.05
METHODS = ["naive", "drift", "trend"]

# ---------------------------------------------------------------------------
# SQL: user x day calendar, forward fill, window weights, month panel
# ---------------------------------------------------------------------------
cte("p_daily", [], """
SELECT user_id, CAST(ts AS DATE) AS day,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS y,
       COUNT(*) AS n, COUNT(*) FILTER (WHERE event_type = 'error') AS err
FROM events GROUP BY user_id, CAST(ts AS DATE)
""")
cte("p_user_day", ["p_daily"], """
SELECT d.user_id, d.day, dl.y,
       CAST(coalesce(dl.n, 0) AS BIGINT) AS n, CAST(coalesce(dl.err, 0) AS BIGINT) AS err
FROM (SELECT user_id, CAST(unnest(generate_series(CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP),
                                                  INTERVAL 1 DAY)) AS DATE) AS day
      FROM p_daily GROUP BY user_id) d
LEFT JOIN p_daily dl ON dl.user_id = d.user_id AND dl.day = d.day
""")
cte("p_ffill", ["p_user_day"], """
SELECT user_id, day, y, n, err,
       coalesce(last_value(y IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0) AS y_ffill
FROM p_user_day
""")
cte("p_weights", ["p_ffill"], f"""
SELECT *, CAST(greatest(0, least(i, cnt - {W}) - greatest(0, i - {W - 1}) + 1) AS BIGINT) AS weight
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day) - 1 AS i,
             COUNT(*) OVER (PARTITION BY user_id) AS cnt FROM p_ffill WHERE day < DATE '{CUTOFF_DAY}') t
""")


def _moment_sql(f: str) -> str:
    mean = f"(SELECT sum(CAST({f} AS DOUBLE) * weight) / sum(weight) FROM p_weights)"
    return (f"SELECT '{f}' AS feature, {mean} AS mean, "
            f"(SELECT sqrt(sum(weight * (CAST({f} AS DOUBLE) - {mean}) * (CAST({f} AS DOUBLE) - {mean})) / sum(weight)) FROM p_weights) AS std")


cte("p_norm_stats", ["p_weights"], " UNION ALL ".join(_moment_sql(f) for f in FEATS))

_Z = ", ".join(
    f"(f.{c} - (SELECT mean FROM p_norm_stats WHERE feature = '{c}')) / "
    f"(SELECT CASE WHEN std = 0 THEN 1.0 ELSE std END FROM p_norm_stats WHERE feature = '{c}') AS z_{c}"
    for c in FEATS)
cte("p_z", ["p_ffill", "p_norm_stats"], f"SELECT f.user_id, f.day, {_Z} FROM p_ffill f")
cte("p_scores", ["p_z"], """
SELECT user_id, day, z_y_ffill * z_y_ffill AS score,
       quantile_cont(z_y_ffill * z_y_ffill, 0.95) OVER (PARTITION BY user_id) AS threshold
FROM p_z
""")

cte("p_month", [], """
SELECT 'N' || lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS iso_code,
       CAST(date_trunc('month', o.o_orderdate) AS DATE) AS ds,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY c.c_nationkey, date_trunc('month', o.o_orderdate)
""")


# ---------------------------------------------------------------------------
# Spark builders
# ---------------------------------------------------------------------------
def ffilled(spark, sf):
    return win.ffill(proxy.user_day(spark, sf), "user_id", "day", ["y"], leading=0.0, suffix="_ffill")


def norm_stats(spark, sf):
    before = flt.before(ffilled(spark, sf), "day", F.lit(CUTOFF_DAY).cast("date"))
    wts = win.window_weights(before, "user_id", "day", W)
    return agg.weighted_moments(wts, FEATS, "weight")


def zscored(spark, sf):
    return an.zscore(ffilled(spark, sf), norm_stats(spark, sf), FEATS)


def scored(spark, sf):
    z = zscored(spark, sf).select("user_id", "day", (F.col("z_y_ffill") * F.col("z_y_ffill")).alias("score"))
    return an.flag_top(z, "user_id", "score", CONTAMINATION)


def month(spark, sf, exact: bool = True):
    m = proxy.month_panel(spark, sf)
    return m.withColumn("y", money("y")) if exact else m


# ---------------------------------------------------------------------------
# Windows
# ---------------------------------------------------------------------------
@register("ffill", ["p_ffill"], "SELECT user_id, day, y_ffill, n, err FROM p_ffill")
def q_ffill(spark, sf):
    return ffilled(spark, sf).select("user_id", "day", "y_ffill", "n", "err")


@register("sequences", ["p_ffill"], f"""
SELECT user_id, start, flatten(win) AS seq FROM (
  SELECT user_id, day AS start,
         list([y_ffill, CAST(n AS DOUBLE), CAST(err AS DOUBLE)]) OVER (
           PARTITION BY user_id ORDER BY day ROWS BETWEEN CURRENT ROW AND {W - 1} FOLLOWING) AS win
  FROM p_ffill) t
WHERE len(win) = {W}
""")
def q_sequences(spark, sf):
    return win.sequences(ffilled(spark, sf), "user_id", "day", FEATS, W)


@register("norm_stats", ["p_norm_stats"],
          "SELECT feature, round(mean, 6) AS mean, round(std, 6) AS std FROM p_norm_stats")
def q_norm_stats(spark, sf):
    return norm_stats(spark, sf).select("feature", *[F.round(c, 6).alias(c) for c in ("mean", "std")])


@register("zscore", ["p_z"], f"SELECT user_id, day, {', '.join(f'round(z_{c}, 6) AS z_{c}' for c in FEATS)} FROM p_z")
def q_zscore(spark, sf):
    return zscored(spark, sf).select("user_id", "day", *[F.round(f"z_{c}", 6).alias(f"z_{c}") for c in FEATS])


@register("holdout_split", ["p_month"], f"""
SELECT iso_code, ds, y,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY iso_code ORDER BY ds DESC) <= {H}
            THEN 'valid' ELSE 'train' END AS split
FROM p_month
""")
def q_holdout_split(spark, sf):
    return win.holdout(month(spark, sf, exact=False), "iso_code", "ds", H)


@register("min_history", ["p_month"], f"""
SELECT iso_code, count(*) AS n_points, count(*) >= {MIN_POINTS} AS eligible
FROM p_month WHERE y IS NOT NULL GROUP BY iso_code
""")
def q_min_history(spark, sf):
    return flt.min_history(month(spark, sf, exact=False), "iso_code", MIN_POINTS, "y")[1]


@register("folds", ["p_month"], f"""
SELECT iso_code, ds, CAST(NTILE({K_FOLDS}) OVER (PARTITION BY iso_code ORDER BY ds) AS INTEGER) AS fold
FROM p_month
""")
def q_folds(spark, sf):
    return win.folds(month(spark, sf, exact=False), "iso_code", "ds", K_FOLDS).select("iso_code", "ds", "fold")


@register("future_steps", ["p_gold"], f"""
SELECT iso_code, CAST(r.step AS INTEGER) AS step, CAST(last_year + r.step AS INTEGER) AS year,
       make_date(CAST(last_year + r.step AS INTEGER), 1, 1) AS ds
FROM (SELECT iso_code, max(year) AS last_year FROM p_gold GROUP BY iso_code) l,
     range(1, {FUTURE_YEARS + 1}) r(step)
""")
def q_future_steps(spark, sf):
    fs = win.future_steps(gold(spark, sf), "iso_code", "year", FUTURE_YEARS)
    return fs.withColumn("ds", to_ds("year"))


@register("cutoff_split", ["p_gold"], f"SELECT iso_code, year, co2 FROM p_gold WHERE year < {CUTOFF_YEAR}")
def q_cutoff_split(spark, sf):
    return flt.before(gold(spark, sf), "year", CUTOFF_YEAR).select("iso_code", "year", "co2")


# ---------------------------------------------------------------------------
# Forecasts
# ---------------------------------------------------------------------------
def _summary_sql(src: str, where: str = "") -> str:
    return f"""
SELECT iso_code, count(*) AS n_, CAST(sum(t) AS BIGINT) AS st, CAST(sum(t * t) AS BIGINT) AS stt,
       sum(yd) AS sy, sum(yd * t) AS sty,
       CAST(arg_min(yd, t) AS DOUBLE) AS y_first, CAST(arg_max(yd, t) AS DOUBLE) AS y_last,
       max(ds) AS last_ds
FROM (SELECT iso_code, ds, CAST(y AS DECIMAL(18,2)) AS yd,
             ROW_NUMBER() OVER (PARTITION BY iso_code ORDER BY ds) - 1 AS t
      FROM {src} WHERE y IS NOT NULL {where}) p
GROUP BY iso_code"""


def _fit_sql(src: str) -> str:
    return f"""
SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(st AS DOUBLE)) / CAST(n_ AS DOUBLE) AS intercept
FROM (SELECT *, CAST(n_ * sty - st * sy AS DOUBLE) / NULLIF(CAST(n_ * stt - st * st AS DOUBLE), 0.0) AS slope
      FROM {src}) s"""


_FORMULA = {
    "naive": "y_last",
    "drift": "y_last + step * (y_last - y_first) / (n_ - 1)",
    "trend": "intercept + slope * (n_ - 1 + step)",
}

cte("p_month_sum", ["p_month"], _summary_sql("p_month"))
cte("p_month_fit", ["p_month_sum"], _fit_sql("p_month_sum"))


def _forecast_sql(method: str, fit: str) -> str:
    return f"""
SELECT iso_code, step, ds, round(forecast, 2) AS forecast, '{method}' AS method,
       CASE WHEN abs(f_last - f_first) < 1 THEN 'flat' WHEN f_last - f_first > 0 THEN 'up' ELSE 'down' END
         AS direction
FROM (SELECT *, arg_min(forecast, step) OVER (PARTITION BY iso_code) AS f_first,
                arg_max(forecast, step) OVER (PARTITION BY iso_code) AS f_last
      FROM (SELECT iso_code, CAST(r.step AS INTEGER) AS step,
                   CAST(last_ds + to_months(CAST(r.step AS INTEGER)) AS DATE) AS ds,
                   {_FORMULA[method].replace('step', 'r.step')} AS forecast
            FROM {fit}, range(1, {H + 1}) r(step)) a) b
"""


def _forecast_q(method):
    def run(spark, sf):
        f = fc.forecast(month(spark, sf), "iso_code", "ds", "y", H, method)
        return f.withColumn("forecast", F.round("forecast", 2))
    return run


for _m in METHODS:
    register(f"forecast_{_m}", ["p_month_fit"], _forecast_sql(_m, "p_month_fit"))(_forecast_q(_m))


_SUMS_SQL = ("count(*) AS n_, CAST(sum(t) AS BIGINT) AS st, CAST(sum(t * t) AS BIGINT) AS stt, "
             "sum(yd) AS sy, sum(yd * t) AS sty")


def _cv_ctes(p: str, src: str, alpha: float, h: int) -> None:
    """CTEs ``p``_base to ``p``_bounds: CV+ bounds of the series in ``src``."""
    cte(f"{p}_base", [src], f"""
SELECT iso_code, ds, CAST(y AS DECIMAL(18,2)) AS yd,
       ROW_NUMBER() OVER (PARTITION BY iso_code ORDER BY ds) - 1 AS t,
       NTILE({K_FOLDS}) OVER (PARTITION BY iso_code ORDER BY ds) AS fold
FROM {src} WHERE y IS NOT NULL
""")
    cte(f"{p}_tot", [f"{p}_base"], f"SELECT iso_code, {_SUMS_SQL} FROM {p}_base GROUP BY iso_code")
    cte(f"{p}_fold", [f"{p}_base"], f"SELECT iso_code, fold, {_SUMS_SQL} FROM {p}_base GROUP BY iso_code, fold")
    cte(f"{p}_fit", [f"{p}_tot", f"{p}_fold"], f"""
SELECT iso_code, fold, nk, b, (CAST(sy AS DOUBLE) - b * CAST(st AS DOUBLE)) / CAST(n_ AS DOUBLE) AS a
FROM (SELECT f.iso_code, f.fold, t.n_ AS nk, t.n_ - f.n_ AS n_, t.st - f.st AS st, t.sy - f.sy AS sy,
             CAST((t.n_ - f.n_) * (t.sty - f.sty) - (t.st - f.st) * (t.sy - f.sy) AS DOUBLE)
               / NULLIF(CAST((t.n_ - f.n_) * (t.stt - f.stt) - (t.st - f.st) * (t.st - f.st) AS DOUBLE), 0.0) AS b
      FROM {p}_fold f JOIN {p}_tot t ON f.iso_code = t.iso_code) s
""")
    cte(f"{p}_bounds", [f"{p}_base", f"{p}_fit"], f"""
SELECT iso_code, step,
       max(CASE WHEN rlo = floor(CAST({alpha} AS DOUBLE) * (nk + 1) + 1e-9) THEN lo END) AS lower,
       max(CASE WHEN rhi = ceil(CAST({1 - alpha} AS DOUBLE) * (nk + 1) - 1e-9) THEN hi END) AS upper
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY iso_code, step ORDER BY lo) AS rlo,
                ROW_NUMBER() OVER (PARTITION BY iso_code, step ORDER BY hi) AS rhi
      FROM (SELECT iso_code, step, nk, mu - r AS lo, mu + r AS hi
            FROM (SELECT p.iso_code, CAST(s.step AS INTEGER) AS step, f.nk,
                         abs(CAST(p.yd AS DOUBLE) - (f.a + f.b * p.t)) AS r,
                         f.a + f.b * (f.nk - 1 + s.step) AS mu
                  FROM {p}_base p JOIN {p}_fit f ON p.iso_code = f.iso_code AND p.fold = f.fold,
                       range(1, {h + 1}) s(step)) x) y) z
GROUP BY iso_code, step
""")


_cv_ctes("p_cv", "p_month", ALPHA, H)


@register("cv_plus_intervals", ["p_month_fit", "p_cv_bounds"], f"""
SELECT c.iso_code, c.step, c.ds, round(c.forecast, 2) AS forecast,
       round(b.lower, 2) AS lower, round(b.upper, 2) AS upper
FROM (SELECT iso_code, CAST(r.step AS INTEGER) AS step,
             CAST(last_ds + to_months(CAST(r.step AS INTEGER)) AS DATE) AS ds,
             intercept + slope * (n_ - 1 + r.step) AS forecast
      FROM p_month_fit, range(1, {H + 1}) r(step)) c
LEFT JOIN p_cv_bounds b ON c.iso_code = b.iso_code AND c.step = b.step
""")
def q_cv_plus(spark, sf):
    r = fc.cv_plus(month(spark, sf), "iso_code", "ds", "y", H, ALPHA, K_FOLDS)
    return r.select("iso_code", "step", "ds", *[F.round(c, 2).alias(c) for c in ["forecast", "lower", "upper"]])


# ---------------------------------------------------------------------------
# Yearly forecast of the keys with enough history
# ---------------------------------------------------------------------------
YEARLY_POINTS, YEARLY_ALPHA = 5, 0.25

cte("p_customer_year", [], """
SELECT iso_code, ds, y FROM (
  SELECT o_custkey AS iso_code, CAST(year(o_orderdate) AS INTEGER) AS ds, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY o_custkey, year(o_orderdate)) t
""")
cte("p_yearly", ["p_customer_year"], f"""
SELECT iso_code, ds, y FROM (SELECT *, count(y) OVER (PARTITION BY iso_code) AS n FROM p_customer_year) t
WHERE n >= {YEARLY_POINTS}
""")
cte("p_yearly_sum", ["p_yearly"], _summary_sql("p_yearly"))
cte("p_yearly_fit", ["p_yearly_sum"], _fit_sql("p_yearly_sum"))
_cv_ctes("p_ycv", "p_yearly", YEARLY_ALPHA, FUTURE_YEARS)


def _cents_sql(c: str) -> str:
    """Half cents are common here and differ in the last bit between engines: the guard sends them up in both."""
    return f"floor({c} * 100 + 0.5001) / 100"


@register("forecast_yearly", ["p_yearly_fit", "p_ycv_bounds"], f"""
SELECT c.iso_code AS custkey, c.step, c.year, {_cents_sql('c.forecast')} AS forecast, {_cents_sql('b.lower')} AS lower, {_cents_sql('b.upper')} AS upper,
       CASE WHEN abs(f_last - f_first) < 1 THEN 'flat' WHEN f_last - f_first > 0 THEN 'up' ELSE 'down' END AS direction
FROM (SELECT *, arg_min(forecast, step) OVER (PARTITION BY iso_code) AS f_first, arg_max(forecast, step) OVER (PARTITION BY iso_code) AS f_last
      FROM (SELECT iso_code, CAST(r.step AS INTEGER) AS step, CAST(last_ds + r.step AS INTEGER) AS year,
                   intercept + slope * (n_ - 1 + r.step) AS forecast
            FROM p_yearly_fit, range(1, {FUTURE_YEARS + 1}) r(step)) x) c
LEFT JOIN p_ycv_bounds b ON c.iso_code = b.iso_code AND c.step = b.step
""")
def q_forecast_yearly(spark, sf):
    """Order value per customer and year, for the customers with enough years."""
    panel = (proxy.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year"))
                  .agg(F.sum(money("o_totalprice")).alias("y")))
    r = fc.panel_forecast(panel, "custkey", "year", "y", FUTURE_YEARS, YEARLY_POINTS, YEARLY_ALPHA, K_FOLDS)
    return r.select("custkey", "step", "year", *[F.expr(_cents_sql(c)).alias(c) for c in ["forecast", "lower", "upper"]], "direction")


# ---------------------------------------------------------------------------
# Forecast evaluation (hold-out) and segments
# ---------------------------------------------------------------------------
cte("p_split", ["p_month"], f"""
SELECT iso_code, ds, y,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY iso_code ORDER BY ds DESC) <= {H}
            THEN 'valid' ELSE 'train' END AS split
FROM p_month WHERE y IS NOT NULL
""")
cte("p_train_sum", ["p_split"], _summary_sql("p_split", "AND split = 'train'"))
cte("p_train_fit", ["p_train_sum"], _fit_sql("p_train_sum"))
cte("p_eval_pairs", ["p_train_fit", "p_split"], f"""
SELECT f.iso_code, f.method, f.step, v.y, f.forecast FROM (
  SELECT iso_code, m.method, CAST(r.step AS INTEGER) AS step,
         CASE m.method WHEN 'naive' THEN {_FORMULA['naive']}
                       WHEN 'drift' THEN {_FORMULA['drift'].replace('step', 'r.step')}
                       ELSE {_FORMULA['trend'].replace('step', 'r.step')} END AS forecast
  FROM p_train_fit, range(1, {H + 1}) r(step), (VALUES ('naive'), ('drift'), ('trend')) m(method)) f
JOIN (SELECT iso_code, y, CAST(ROW_NUMBER() OVER (PARTITION BY iso_code ORDER BY ds) AS INTEGER) AS step
      FROM p_split WHERE split = 'valid') v
  ON f.iso_code = v.iso_code AND f.step = v.step
""")
cte("p_eval", ["p_eval_pairs"], """
SELECT iso_code, method,
       CASE WHEN n_ < 2 THEN CAST('nan' AS DOUBLE)
            WHEN naive = 0 THEN CASE WHEN mae > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END
            ELSE mae / naive END AS mase,
       CASE WHEN npos = 0 THEN 0.0 ELSE 100.0 / n_ * s END AS smape
FROM (SELECT iso_code, method, count(*) AS n_, avg(abs(y - forecast)) AS mae, avg(dy) AS naive,
             sum(CASE WHEN den > 0 THEN 2.0 * abs(y - forecast) / den ELSE 0.0 END) AS s,
             count(*) FILTER (WHERE den > 0) AS npos
      FROM (SELECT *, abs(y - LAG(y) OVER (PARTITION BY iso_code, method ORDER BY step)) AS dy,
                   abs(y) + abs(forecast) AS den FROM p_eval_pairs) d
      GROUP BY iso_code, method) a
""")


def evaluation(spark, sf):
    m = month(spark, sf)
    split = win.holdout(m.where(F.col("y").isNotNull()), "iso_code", "ds", H)
    train = split.where(F.col("split") == "train")
    valid = win.positions(split.where(F.col("split") == "valid"), "iso_code", "ds", "step") \
        .withColumn("step", (F.col("step") + 1).cast("int")) \
        .select("iso_code", "step", F.col("y").cast("double").alias("y"))
    # all methods from one per-key summary of the training rows
    fcs = fc.forecast(train, "iso_code", "ds", "y", H, METHODS).select("iso_code", "step", "method", "forecast")
    pairs = align(fcs, valid, "iso_code", "step", by=["method"])
    return mt.mase_smape(pairs, ["iso_code", "method"], "step", "y", "forecast"), train


@register("forecast_eval", ["p_eval"],
          "SELECT iso_code, method, round(mase, 3) AS mase, round(smape, 3) AS smape FROM p_eval")
def q_forecast_eval(spark, sf):
    scores, _ = evaluation(spark, sf)
    return scores.select("iso_code", "method", F.round("mase", 3).alias("mase"), F.round("smape", 3).alias("smape"))


@register("segment_metrics", ["p_eval", "p_split"], """
SELECT segment, method, n_keys, round(mase, 3) AS mase, round(smape, 3) AS smape FROM (
  SELECT s.segment, e.method, count(*) FILTER (WHERE isfinite(e.mase) AND isfinite(e.smape)) AS n_keys,
         avg(e.mase) FILTER (WHERE isfinite(e.mase) AND isfinite(e.smape)) AS mase,
         avg(e.smape) FILTER (WHERE isfinite(e.mase) AND isfinite(e.smape)) AS smape
  FROM p_eval e JOIN (
    SELECT iso_code, CASE NTILE(5) OVER (ORDER BY total DESC, iso_code) WHEN 1 THEN 'high' WHEN 5 THEN 'low'
                     ELSE 'mid' END AS segment
    FROM (SELECT iso_code, sum(CAST(y AS DECIMAL(18,2))) AS total FROM p_split WHERE split = 'train'
          GROUP BY iso_code) t) s ON e.iso_code = s.iso_code
  GROUP BY s.segment, e.method
  UNION ALL
  SELECT 'overall', method, count(*), avg(mase), avg(smape)
  FROM p_eval WHERE isfinite(mase) AND isfinite(smape) GROUP BY method) u
""")
def q_segment_metrics(spark, sf):
    scores, train = evaluation(spark, sf)
    totals = train.groupBy("iso_code").agg(F.sum("y").alias("total"))
    seg = mt.segments(totals, "iso_code", "total")
    out = mt.segment_metrics(scores, seg, "iso_code", ["method"])
    return out.select("segment", "method", "n_keys", F.round("mase", 3).alias("mase"),
                      F.round("smape", 3).alias("smape"))


# ---------------------------------------------------------------------------
# Anomalies and score summaries
# ---------------------------------------------------------------------------
@register("anomaly_flags", ["p_scores"], """
SELECT user_id, day, round(score, 6) AS score, round(threshold, 6) AS threshold,
       coalesce(score > threshold, FALSE) AS is_anomaly
FROM p_scores
""")
def q_anomaly_flags(spark, sf):
    s = scored(spark, sf)
    return s.select("user_id", "day", F.round("score", 6).alias("score"),
                    F.round("threshold", 6).alias("threshold"), "is_anomaly")


@register("error_summary", ["p_scores"], """
SELECT round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS std, round(max(score), 6) AS max,
       round(quantile_cont(score, 0.95), 6) AS p95, round(quantile_cont(score, 0.99), 6) AS p99
FROM p_scores
""")
def q_error_summary(spark, sf):
    s = agg.error_summary(scored(spark, sf), "score")
    return s.select(*[F.round(c, 6).alias(c) for c in ["mean", "std", "max", "p95", "p99"]])


_EVENTS_SQL = ", ".join(f"({y}, '{lab}')" for y, lab in sorted(an.KNOWN_EVENTS.items()))
cte("p_feed_scores", ["p_change"], """
SELECT iso_code, year, z * z AS score FROM (
  SELECT iso_code, year, (pct - avg(pct) OVER ()) / stddev_pop(pct) OVER () AS z FROM p_change) b
""")


@register("anomaly_feed", ["p_feed_scores"], f"""
SELECT iso_code, year, is_anomaly, round(score, 6) AS score, coalesce(e.event_label, '') AS event_label,
       count(*) FILTER (WHERE is_anomaly) OVER (PARTITION BY iso_code) AS total_anomalies
FROM (SELECT *, coalesce(score > quantile_cont(score, {1 - CONTAMINATION}) OVER (PARTITION BY iso_code), FALSE)
                  AS is_anomaly FROM p_feed_scores) f
LEFT JOIN (VALUES {_EVENTS_SQL}) e(ev_year, event_label) ON f.year = e.ev_year
""")
def q_anomaly_feed(spark, sf):
    from paneltide.operators.windows import yoy

    y = yoy(staged(spark, sf), "iso_code", "year", "co2")
    stats = an.standardize_stats(y, ["co2_yoy_pct"])
    z = an.zscore(y, stats, ["co2_yoy_pct"])
    s = z.select("iso_code", "year", (F.col("z_co2_yoy_pct") * F.col("z_co2_yoy_pct")).alias("score"))
    feed = an.anomaly_feed(s, "iso_code", "year", "score", CONTAMINATION)
    return feed.withColumn("score", F.round("score", 6))
