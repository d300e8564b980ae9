"""Forecasting for every series at once (M1, M2) - one job over all keys
instead of one model call per key.

Methods (re-aimed from the reference's neural models, see README):
naive (last value), drift (last value + average step), trend (OLS line on
the 0-based time index). Intervals: CV+ (jackknife+ with K contiguous folds,
Barber et al. 2021) around the trend line, as the reference's conformal
helper does.

The trend fit uses per-key sufficient statistics (n, sum t, sum t^2, sum y,
sum t*y). With decimal y these sums are exact, the leave-one-fold-out fits
are plain subtractions of fold sums from key sums, and the result does not
depend on the order in which rows are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.exprs import direction_label
from paneltide.operators.filters import min_history
from paneltide.operators.windows import folds as fold_labels
from paneltide.operators.windows import positions

_SUMS = ["_n", "_st", "_stt", "_sy", "_sty"]


def _sums(df: DataFrame, by: list[str], t: str, y: str) -> DataFrame:
    tt = F.col(t).cast("long")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(tt).alias("_st"), F.sum(tt * tt).alias("_stt"),
        F.sum(y).alias("_sy"), F.sum(F.col(y) * tt).alias("_sty"),
    )


def ols_from_sums(n: Column, st: Column, stt: Column, sy: Column, sty: Column):
    """(slope, intercept) of y on t; NULL slope when t has no spread."""
    num = (n * sty - st * sy).cast("double")
    den = (n * stt - st * st).cast("double")
    slope = F.try_divide(num, F.nullif(den, F.lit(0.0)))
    intercept = (sy.cast("double") - slope * st.cast("double")) / n.cast("double")
    return slope, intercept


def _advance(ds: Column, step: Column, unit: str) -> Column:
    if unit == "month":
        return F.add_months(ds, step)
    if unit == "year":
        return ds + step
    raise ValueError(unit)


def series_summary(df: DataFrame, key: str, ds: str, y: str) -> DataFrame:
    """Per key: trend sums, first/last value, last time step."""
    p = positions(df.where(F.col(y).isNotNull()), key, ds, "_t")
    s = p.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_t").alias("_st"),
        F.sum(F.col("_t") * F.col("_t")).alias("_stt"),
        F.sum(y).alias("_sy"), F.sum(F.col(y) * F.col("_t")).alias("_sty"),
        F.min_by(y, "_t").cast("double").alias("y_first"),
        F.max_by(y, "_t").cast("double").alias("y_last"),
        F.max(ds).alias("last_ds"),
    )
    slope, intercept = ols_from_sums(*[F.col(c) for c in _SUMS])
    return s.withColumn("slope", slope).withColumn("intercept", intercept)


def _method_forecast(method: str) -> Column:
    step, n = F.col("step"), F.col("_n")
    if method == "naive":
        return F.col("y_last")
    if method == "drift":
        return F.col("y_last") + F.try_divide(step * (F.col("y_last") - F.col("y_first")), n - 1)  # NULL for one point
    if method == "trend":
        return F.col("intercept") + F.col("slope") * (n - 1 + step)
    raise ValueError(method)


def forecast(df: DataFrame, key: str, ds: str, y: str, h: int, method="trend",
             unit: str = "month") -> DataFrame:
    """M1 + P16: h-step point forecasts for every key.

    ``method`` is one method name or a list of them; several methods come
    from the same per-key summary in one pass (no union of per-method plans).
    Output: key, step, ds, forecast, method, direction (flat/up/down from the
    first to the last forecast step of that key and method)."""
    methods = [method] if isinstance(method, str) else list(method)
    per_method = F.array(*[F.struct(F.lit(m).alias("method"), _method_forecast(m).alias("forecast"))
                           for m in methods])
    s = series_summary(df, key, ds, y)
    out = (s.select(key, "last_ds", "_n", "y_last", "y_first", "slope", "intercept",
                    F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"))
             .select(key, "last_ds", "step", F.explode(per_method).alias("_m"))
             .select(key, "last_ds", "step", "_m.method", "_m.forecast"))
    w = Window.partitionBy(key, "method")
    first = F.min_by("forecast", "step").over(w)
    last = F.max_by("forecast", "step").over(w)
    return out.select(key, "step", _advance(F.col("last_ds"), F.col("step"), unit).alias(ds), "forecast", "method",
                      direction_label(first, last).alias("direction"))


def _leading(size: Column, powers: Column, holds) -> Column:
    """How many of the places 1 .. size, from the first on, satisfy ``holds``
    (true up to some place, false after it), by bisection in ``powers`` steps."""
    return F.aggregate(powers, F.lit(0), lambda at, s: F.when((at + s <= size) & holds(at + s), at + s).otherwise(at))


def kth_of_lists(lists: Column, powers: Column, m: Column) -> Column:
    """The m-th smallest of all ``at + values[j]`` of an array of structs
    (at, values ascending); NULL if there are fewer. For each list, bisection
    finds its first value that m values of all lists don't exceed (each such
    count is a bisection in every list); the least of those is the answer. No
    list is merged or sorted again."""
    value = lambda f, j: f["at"] + F.get(f["values"], j - 1)

    def rank(v: Column) -> Column:
        upto = lambda f: _leading(F.size(f["values"]), powers, lambda j: value(f, j) <= v)
        return F.aggregate(lists, F.lit(0), lambda acc, f: acc + upto(f))

    def first(f: Column) -> Column:
        below = _leading(F.size(f["values"]), powers, lambda j: rank(value(f, j)) < m)
        return value(f, below + 1)  # NULL past the end

    return F.when(m >= 1, F.array_min(F.transform(lists, first)))


def cv_plus(df: DataFrame, key: str, ds: str, y: str, h: int, alpha: float = 0.1, k: int = 5,
            unit: str = "month") -> DataFrame:
    """M2: CV+ prediction intervals of a linear trend on the time index.

    For each key: K contiguous folds; the trend refitted without each fold;
    residuals of each point under the fit that excluded its fold; then for
    each future step x the interval is
        lower = the floor(alpha (n+1))-th smallest of  mu_-k(i)(x) - r_i
        upper = the ceil((1-alpha)(n+1))-th smallest of mu_-k(i)(x) + r_i
    (NULL when that order statistic does not exist, i.e. the series is too
    short for the level, or for a trend without a fold).

    A fold's residuals are sorted once. A step only shifts each fold's list by
    that fold's forecast, so its bounds are selected from K sorted lists
    (``kth_of_lists``): one row per key holds the n residuals, and no row is
    made for a point and step. Nothing crosses keys.
    """
    base = positions(df.where(F.col(y).isNotNull()), key, ds, "_t")
    base = fold_labels(base, key, ds, k, "_fold")
    tot = _sums(base, [key], "_t", y)
    per_fold = _sums(base, [key, "_fold"], "_t", y).select(
        key, "_fold", *[F.col(c).alias(c + "_f") for c in _SUMS])
    lo_fit = per_fold.join(tot, key)
    slope, intercept = ols_from_sums(*[F.col(c) - F.col(c + "_f") for c in _SUMS])
    fits = lo_fit.select(key, "_fold", slope.alias("_b"), intercept.alias("_a"),
                         F.col("_n").alias("_nk"))
    pts = base.join(fits, [key, "_fold"])
    pts = pts.withColumn("_r", F.abs(F.col(y).cast("double") - (F.col("_a") + F.col("_b") * F.col("_t"))))
    lists = pts.where(F.col("_r").isNotNull()).groupBy(key, "_nk", "_fold", "_a", "_b").agg(F.sort_array(F.collect_list("_r")).alias("_hi"))
    fold = F.struct("_a", "_b", "_hi", F.reverse(F.transform("_hi", lambda r: -r)).alias("_lo"))
    series = lists.groupBy(key, "_nk").agg(F.collect_list(fold).alias("_folds"))
    most = F.array_max(F.transform("_folds", lambda f: F.size(f["_hi"])))
    powers = F.transform(F.sequence(F.floor(F.log2(most)).cast("int"), F.lit(0)), lambda b: F.pow(F.lit(2), b).cast("int"))
    # order-statistic ranks; the 1e-9 guard keeps exact products such as
    # 0.9 * 90 = 81 from rounding up to 82 in floating point
    k_lo = F.floor(F.lit(alpha) * (F.col("_nk") + 1) + F.lit(1e-9)).cast("int")
    k_hi = F.ceil(F.lit(1 - alpha) * (F.col("_nk") + 1) - F.lit(1e-9)).cast("int")

    def bound(step: Column, side: str, m: Column) -> Column:
        at = lambda f: f["_a"] + f["_b"] * (F.col("_nk") - 1 + step)
        return kth_of_lists(F.transform("_folds", lambda f: F.struct(at(f).alias("at"), f[side].alias("values"))), F.col("_p"), m)

    per_step = F.transform(F.sequence(F.lit(1), F.lit(h)), lambda x: F.struct(
        x.alias("step"), bound(x, "_lo", F.col("_klo")).alias("lower"), bound(x, "_hi", F.col("_khi")).alias("upper")))
    series = series.select(key, "_nk", "_folds", powers.alias("_p"), k_lo.alias("_klo"), k_hi.alias("_khi"))
    bounds = series.select(key, F.explode(per_step).alias("_s")).select(key, "_s.*")
    center = forecast(df, key, ds, y, h, "trend", unit).select(key, "step", ds, "forecast")
    return center.join(bounds, [key, "step"], "left")


def panel_forecast(df: DataFrame, key: str, t: str, y: str, h: int, min_points: int, alpha: float = 0.1, k: int = 5,
                   unit: str = "year") -> DataFrame:
    """F10 -> M1 -> M2 -> P16: trend forecasts with CV+ bounds and direction
    of the keys with at least ``min_points`` values; shorter series give no
    rows (``min_history`` reports them)."""
    eligible, _ = min_history(df, key, min_points, y)
    out = cv_plus(eligible, key, t, y, h, alpha, k, unit)
    w = Window.partitionBy(key)
    first, last = F.min_by("forecast", "step").over(w), F.max_by("forecast", "step").over(w)
    return out.withColumn("direction", direction_label(first, last))
