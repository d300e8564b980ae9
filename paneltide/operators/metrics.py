"""Forecast error metrics (A14-A17, M3) as grouped aggregates per key.

MASE   = mean |y - f| / mean |y_t - y_(t-1)| over the evaluated actuals;
         fewer than 2 points -> NaN; zero denominator -> inf, or 0 when
         there is no error either.
sMAPE  = 100 / n * sum over points with |y| + |f| > 0 of 2|y - f| / (|y| + |f|)
         (0..200; points with a zero denominator add 0 but still count in n;
         all-zero -> 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.operators.ordering import global_positions

NAN = float("nan")
INF = float("inf")


def mase_smape(pairs: DataFrame, key: list[str] | str, order: str, y: str = "y", f: str = "forecast") -> DataFrame:
    """A14 + A15 + W4 per key from aligned (actual, forecast) rows."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(order)
    yy, ff = F.col(y).cast("double"), F.col(f).cast("double")
    d = pairs.withColumn("_dy", F.abs(yy - F.lag(yy).over(w)))
    den = F.abs(yy) + F.abs(ff)
    a = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.avg(F.abs(yy - ff)).alias("_mae"),
        F.avg("_dy").alias("_naive"),
        F.sum(F.when(den > 0, F.lit(2.0) * F.abs(yy - ff) / den).otherwise(F.lit(0.0))).alias("_s"),
        F.count_if(den > 0).alias("_npos"),
    )
    mase = (F.when(F.col("_n") < 2, F.lit(NAN))
            .when(F.col("_naive") == 0, F.when(F.col("_mae") > 0, F.lit(INF)).otherwise(F.lit(0.0)))
            .otherwise(F.col("_mae") / F.col("_naive")))
    smape = F.when(F.col("_npos") == 0, F.lit(0.0)).otherwise(F.lit(100.0) / F.col("_n") * F.col("_s"))
    return a.select(*keys, mase.alias("mase"), smape.alias("smape"))


def finite(c) -> F.Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(col) & (F.abs(col) != F.lit(INF)), col)


def macro_avg(scores: DataFrame, by: list[str], cols=("mase", "smape")) -> DataFrame:
    """Unweighted mean over the keys whose scores are all finite, and how
    many they are."""
    whole = F.lit(True)
    for c in cols:
        whole = whole & finite(c).isNotNull()
    return scores.groupBy(*by).agg(
        F.count_if(whole).alias("n_keys"), *[F.avg(F.when(whole, F.col(c))).alias(c) for c in cols])


def segments(totals: DataFrame, key: str, total: str, top: float = 0.2, bottom: float = 0.2) -> DataFrame:
    """A17 helper: 'high' for the first ``top`` share of the keys by total
    (descending, key as tiebreak), 'low' for the last ``bottom`` share, 'mid'
    otherwise; shares are rounded up to whole keys. The ranking is the
    distributed global ordering, not a single-task window."""
    ranked = global_positions(totals, [F.col(total).desc(), F.col(key)], "_pos", total_col="_cnt")
    share = lambda x: F.ceil(F.round(F.col("_cnt") * F.lit(float(x)), 9))
    seg = (F.when(F.col("_pos") <= share(top), F.lit("high"))
           .when(F.col("_pos") > F.col("_cnt") - share(bottom), F.lit("low")).otherwise(F.lit("mid")))
    return ranked.select(key, total, seg.alias("segment"))


def segment_metrics(scores: DataFrame, seg: DataFrame, key: str, by: list[str]) -> DataFrame:
    """Macro averages per segment plus an 'overall' row."""
    s = scores.join(seg.select(key, "segment"), key)
    per = macro_avg(s, ["segment", *by])
    overall = macro_avg(s, by).withColumn("segment", F.lit("overall"))
    return per.unionByName(overall)
