"""Per-key window operators (W-operators).

Every window here is partitioned by the entity key, so Spark shuffles once on
the key and each task holds whole series. These operators run on the panel
grain (one row per key and time step), so a key's partition is bounded by the
length of its calendar even when the raw data of one key is huge: the raw
rows were already folded by a partial aggregation before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.exprs import safe_div
from paneltide.operators.ordering import global_positions


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def yoy(df: DataFrame, key, t: str, m: str, prefix: str | None = None) -> DataFrame:
    """Previous row's value, change, and percent change (NULL when the
    previous value is 0 or NULL). "Previous" is the previous row of the key in
    time order, so calendar gaps are bridged, as SQL LAG does."""
    p = prefix or m
    w = Window.partitionBy(*_keys(key)).orderBy(t)
    prev = F.lag(m).over(w)
    return (
        df.withColumn(f"{p}_prev_year", prev)
        .withColumn(f"{p}_yoy_change", F.col(m) - F.col(f"{p}_prev_year"))
        .withColumn(
            f"{p}_yoy_pct",
            safe_div(F.col(m) - F.col(f"{p}_prev_year"), F.col(f"{p}_prev_year")) * 100,
        )
    )


def ffill(df: DataFrame, key, t: str, cols: list[str], leading=0.0, suffix: str = "") -> DataFrame:
    """Forward fill inside each key in time order; a leading gap becomes
    ``leading`` (use None to keep it NULL)."""
    w = Window.partitionBy(*_keys(key)).orderBy(t).rowsBetween(Window.unboundedPreceding, 0)
    for c in cols:
        filled = F.last(c, ignorenulls=True).over(w)
        if leading is not None:
            filled = F.coalesce(filled, F.lit(leading))
        df = df.withColumn(c + suffix, filled)
    return df


def sequences(df: DataFrame, key, t: str, feats: list[str], w: int, out: str = "seq", step: str | None = None) -> DataFrame:
    """Sliding windows of ``w`` consecutive rows per key, stride 1, full
    windows only. ``out`` holds the w x len(feats) values row-major (time
    outer, feature inner), i.e. the flattened (w, n_features) tensor. ``start``
    is the window's first time; ``step`` names a column for its last."""
    win = Window.partitionBy(*_keys(key)).orderBy(t).rowsBetween(0, w - 1)
    vec = F.array(*[F.col(f).cast("double") for f in feats])
    last = [] if step is None else [F.col("_last").alias(step)]
    return (
        df.withColumn("_win", F.collect_list(vec).over(win)).withColumn("_last", F.last(t).over(win))
        .where(F.size("_win") == w)
        .select(*_keys(key), F.col(t).alias("start"), *last, F.flatten("_win").alias(out))
    )


def window_weights(df: DataFrame, key, t: str, w: int, out: str = "weight") -> DataFrame:
    """How many full sliding windows of length ``w`` contain each row; the
    moments over all window samples equal weighted moments over rows, so the
    w-fold expansion of W6 is never materialised (A13)."""
    k = _keys(key)
    wi = Window.partitionBy(*k).orderBy(t)
    wn = Window.partitionBy(*k)
    i = F.row_number().over(wi) - 1
    n = F.count(F.lit(1)).over(wn)
    hi = F.least(i, n - w)
    lo = F.greatest(F.lit(0), i - (w - 1))
    return df.withColumn(out, F.greatest(F.lit(0), hi - lo + 1).cast("long"))


def holdout(df: DataFrame, key, t: str, h: int, out: str = "split") -> DataFrame:
    """The last ``h`` rows of each key are 'valid', the rest 'train'."""
    w = Window.partitionBy(*_keys(key)).orderBy(F.col(t).desc())
    return df.withColumn(
        out, F.when(F.row_number().over(w) <= h, F.lit("valid")).otherwise(F.lit("train"))
    )


def dedup(df: DataFrame, keys: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """One row per key, the one that is last (or first) in ``order``; the
    remaining columns break ties, so the choice is deterministic.

    Written as a grouped max/min of a struct rather than a ROW_NUMBER window:
    the aggregate runs partially on the map side, so a key with millions of
    copies is folded inside every task before the shuffle instead of being
    sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(f"`{c}`") for c in order + rest])
    pick = F.max(packed) if keep == "last" else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    # unpack the struct in one projection, then restore the input's order
    return out.select(*keys, "_row.*").select(*df.columns)


def future_steps(df: DataFrame, key, t: str, h: int) -> DataFrame:
    """The ``h`` time steps after each key's last observed step."""
    k = _keys(key)
    last = df.groupBy(*k).agg(F.max(t).alias("_last"))
    return last.select(
        *k,
        F.explode(F.sequence(F.lit(1), F.lit(h))).alias("step"),
        "_last",
    ).select(*k, "step", (F.col("_last") + F.col("step")).alias(t))


def folds(df: DataFrame, key, t: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Contiguous K-fold labels per key (an unshuffled K-fold split: the
    first n % k folds are one row longer)."""
    w = Window.partitionBy(*_keys(key)).orderBy(t)
    return df.withColumn(out, F.ntile(k).over(w))


def positions(df: DataFrame, key, t: str, out: str = "pos") -> DataFrame:
    """0-based time index per key (the x of a trend fitted on np.arange)."""
    w = Window.partitionBy(*_keys(key)).orderBy(t)
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))


def running_total(df: DataFrame, order: list[Column], m: str, out: str = "running_total",
                  partition: list[str] | None = None, rank_col: str | None = "rank") -> DataFrame:
    """Running total of ``m`` in rank order. With ``partition`` it is a
    per-group window; without, the global form avoids a single-task window
    (see ordering.global_positions). Decimal input gives exact totals."""
    if partition:
        w = Window.partitionBy(*partition).orderBy(*order)
        df = df.withColumn(out, F.sum(m).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        if rank_col:
            df = df.withColumn(rank_col, F.row_number().over(w))
        return df
    res = global_positions(df, order, pos_col=rank_col or "_rank", value_col=m, cum_col=out)
    return res if rank_col else res.drop("_rank")


def rank_order(df: DataFrame, order: list[Column], out: str = "rank",
               partition: list[str] | None = None) -> DataFrame:
    """1-based display rank in a total order (put the key last as a
    tiebreak)."""
    if partition:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)))
    return global_positions(df, order, pos_col=out)
