"""Anomaly operators (M4-M8): z-scores with saved statistics, per-key
contamination flags, known-event labels, the anomaly feed, and two
scorers (PCA reconstruction error, isolation forest)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paneltide.operators.comoments import comoments
from paneltide.operators.isolation import forest_scores
from paneltide.operators.joins import attach_scalars, broadcast_if_small
from paneltide.operators.ordering import keyed_quantile

# ---------------------------------------------------------------------------
# Known emission-shock years and their labels.
# ---------------------------------------------------------------------------
KNOWN_EVENTS = {
    1990: "Gulf War oil fires",
    1997: "Asian Financial Crisis",
    2008: "Global Financial Crisis",
    2020: "COVID-19 pandemic",
    2022: "Ukraine war energy shock",
}


def zscore(df: DataFrame, stats: DataFrame, feats: list[str], prefix: str = "z_") -> DataFrame:
    """M4: (x - mean) / std with saved statistics (long form: feature, mean,
    std); a zero std is replaced by 1. The statistics are pivoted to one row
    and broadcast."""
    wide = stats.groupBy().pivot("feature", feats).agg(F.first("mean").alias("m"), F.first("std").alias("s"))
    # pivot with two aggregates names columns <feature>_m / <feature>_s
    out = attach_scalars(df, wide)
    for f in feats:
        sd = F.col(f"{f}_s")
        out = out.withColumn(prefix + f, (F.col(f) - F.col(f"{f}_m"))
                             / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return out.drop(*[f"{f}_m" for f in feats], *[f"{f}_s" for f in feats])


def flag_top(df: DataFrame, key: str, score: str, contamination: float = 0.05,
             out: str = "is_anomaly", series: bool = True) -> DataFrame:
    """M6: flag the scores above the key's (1 - c) quantile (exact, linear
    interpolation).

    ``series`` says that a key's rows are a series (one per time step, so
    bounded by the calendar): the quantile is then a per-key window aggregate
    and the rows are read once. Without it a key is never gathered: the
    quantile comes from ``keyed_quantile`` and is joined back, broadcast when
    the per-key table is small, otherwise by a shuffle join that AQE's skew
    handling splits for a hot key."""
    flag = F.coalesce(F.col(score) > F.col("threshold"), F.lit(False))
    if series:
        thr = F.percentile(F.col(score), 1 - contamination).over(Window.partitionBy(key))
        return df.withColumn("threshold", thr).withColumn(out, flag)
    q = keyed_quantile(df, key, score, 1 - contamination).select(
        F.col(key).alias("_qkey"), F.col("value").alias("threshold"))
    q = broadcast_if_small(q)
    joined = df.join(q, F.col(key).eqNullSafe(F.col("_qkey")), "left").drop("_qkey")
    return joined.withColumn(out, flag)


def event_labels(spark: SparkSession, events: dict[int, str] | None = None) -> DataFrame:
    rows = sorted((events or KNOWN_EVENTS).items())
    return spark.createDataFrame(rows, "year int, event_label string")


def label_events(df: DataFrame, t: str = "year", events: dict[int, str] | None = None) -> DataFrame:
    """Known-event label by year, '' when none (broadcast of a literal
    table)."""
    lab = broadcast_if_small(event_labels(df.sparkSession, events).withColumnRenamed("year", t))
    return (df.join(lab, t, "left")
              .withColumn("event_label", F.coalesce(F.col("event_label"), F.lit(""))))


def anomaly_feed(df: DataFrame, key: str, t: str, score: str, contamination: float = 0.05,
                 events: dict[int, str] | None = None) -> DataFrame:
    """M8: key, time, flag, score, event label, and the key's anomaly count."""
    f = flag_top(df, key, score, contamination)
    f = label_events(f, t, events)
    total = F.count_if(F.col("is_anomaly")).over(Window.partitionBy(key))
    return f.select(key, t, "is_anomaly", score, "event_label", total.alias("total_anomalies"))


def standardize_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Global mean and population std per column (long form), one pass."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"_m{i}"), F.stddev_pop(c).alias(f"_s{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', `_m{i}`, `_s{i}`" for i, c in enumerate(cols))
    return wide.select(F.expr(f"stack({len(cols)}, {parts}) AS (feature, mean, std)"))


# ---------------------------------------------------------------------------
# M5: reconstruction error of sliding windows under a low-rank model
# ---------------------------------------------------------------------------
def principal_axes(train: DataFrame, vec: str, d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, the k leading axes as columns) of the vectors, from their
    co-moments (outer products of blocks in each task, see ``comoments``)."""
    states = comoments(train.where(F.col(vec).isNotNull() & F.forall(vec, lambda v: v.isNotNull())), F.col(vec), F.lit(0), d)
    _, mean, c = states.get(0, (0, np.zeros(d), np.zeros((d, d))))
    return mean, np.linalg.eigh(c)[1][:, ::-1][:, :k]


def pca_recon_error(seqs: DataFrame, key: str, start: str, vec: str, d: int, k: int = 2,
                    fit_before=None, step: str | None = None) -> DataFrame:
    """M5 (re-aimed from an LSTM autoencoder): fit principal axes on the window
    vectors of ``d`` = window x features standardised values (optionally only
    windows that end before ``fit_before``), project every window onto k axes
    and back, score = mean squared reconstruction error over the window. The
    score belongs to the window's last step, ``step`` (default: ``start``). A
    window with a missing value is not fitted and has no score."""
    step = step or start
    train = seqs if fit_before is None else seqs.where(F.col(step) < fit_before)
    mean, axes = principal_axes(train, vec, d, k)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    # the axes are two small arrays of constants, not an expression for each of their entries
    off = seqs.select(key, step, F.zip_with(vec, F.lit(mean.tolist()), lambda v, m: v - m).alias("_c"))
    off = off.withColumn("_z", F.transform(F.lit(axes.T.tolist()), lambda a: dot(F.col("_c"), a)))
    rest = F.zip_with("_c", F.lit(axes.tolist()), lambda v, a: v - dot(F.col("_z"), a))
    return off.select(key, step, (F.aggregate(rest, F.lit(0.0), lambda acc, v: acc + v * v) / d).alias("recon_error"))


def isolation_forest(df: DataFrame, key: str, t: str, feats: list[str], contamination: float = 0.05,
                     n_trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """M7: per-key isolation forest, flagging the top ``contamination`` share
    of each key's scores."""
    out = forest_scores(df, key, t, feats, n_trees, sample, seed)
    return flag_top(out, key, "iforest_score", contamination).drop("threshold")
