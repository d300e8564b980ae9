"""Sorts, top-k and growth rankings (T-operators, J4).

A top-k is ``orderBy(...).limit(k)``, which Spark plans as
TakeOrderedAndProject: each task keeps its own k best rows and only those
reach the final merge. Every ordering ends with the key, so ties are broken
the same way on every run and engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.exprs import safe_div
from paneltide.operators.joins import restrict


def top_n(df: DataFrame, key: str, t: str, m: str, n: int, year: int | None = None) -> DataFrame:
    """The n largest non-NULL values in ``year`` (default: the latest
    year, a scalar subquery)."""
    y = F.lit(year) if year is not None else df.select(F.max(t)).scalar()
    cur = df.where((F.col(t) == y) & F.col(m).isNotNull())
    return cur.orderBy(F.col(m).desc(), F.col(key)).limit(n)


def top_n_history(df: DataFrame, key: str, t: str, m: str, n: int, year: int | None = None) -> DataFrame:
    """Every row of the current top-n keys (semi-join on the key set;
    the top-n set has n rows, so Spark broadcasts it)."""
    keys = top_n(df, key, t, m, n, year).select(key)
    return restrict(df, keys, [key])


def preview(df: DataFrame, key: str, t: str, m: str, cols: list[str], n: int = 50,
            year: int | None = None, digits: int = 2) -> DataFrame:
    """T4: the latest year's n largest rows, value rounded."""
    y = F.lit(year) if year is not None else df.select(F.max(t)).scalar()
    cur = df.where(F.col(t) == y).orderBy(F.col(m).desc_nulls_last(), F.col(key)).limit(n)
    return cur.select(*[F.round(c, digits).alias(c) if c == m else F.col(c) for c in cols])


def growth(df: DataFrame, key: str, t: str, m: str, y0: int, y1: int,
           min_end: float | None = None) -> DataFrame:
    """Percent change between two years for keys present in
    both (and, optionally, above ``min_end`` in the end year).

    One pass instead of a self-join: filter to the two years, group by key
    and pick each year's value with a conditional max. A NULL or zero start
    gives NULL growth, which is dropped (pandas keeps inf; see README)."""
    two = df.where(F.col(t).isin(y0, y1))
    wide = two.groupBy(key).agg(
        F.max(F.when(F.col(t) == y0, F.col(m))).alias("start_value"),
        F.max(F.when(F.col(t) == y1, F.col(m))).alias("end_value"),
    )
    keep = F.col("start_value").isNotNull() & F.col("end_value").isNotNull()
    if min_end is not None:
        keep = keep & (F.col("end_value") > min_end)
    g = safe_div(F.col("end_value") - F.col("start_value"), F.col("start_value")) * 100
    return wide.where(keep).withColumn("growth_pct", g).where(F.col("growth_pct").isNotNull())


def movers(grown: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The n fastest growers and n biggest decliners, with a side column
    and the rank inside each side."""
    up = grown.orderBy(F.col("growth_pct").desc(), F.col(key)).limit(n).withColumn("side", F.lit("grower"))
    down = grown.orderBy(F.col("growth_pct").asc(), F.col(key)).limit(n).withColumn("side", F.lit("decliner"))
    both = up.unionByName(down)
    # at most 2n rows: the window below is on a bounded input
    w = Window.partitionBy("side").orderBy(
        F.when(F.col("side") == "grower", -F.col("growth_pct")).otherwise(F.col("growth_pct")), F.col(key))
    return both.withColumn("rank", F.row_number().over(w))


def bubble(df: DataFrame, key: str, t: str, size: str, ratio: str, n_total: int = 10,
           n_ratio: int = 5, complete: list[str] | None = None, year: int | None = None) -> DataFrame:
    """The latest year's complete rows, flagged as top-n by total and as
    top-n by the ratio column when not already a top total.

    The two top-n sets come from top-k plans (n rows each) and are attached
    with broadcast left joins, so no task ever holds a whole year."""
    y = F.lit(year) if year is not None else df.select(F.max(t)).scalar()
    cur = df.where(F.col(t) == y).dropna(subset=complete or [size, ratio])
    top_tot = cur.orderBy(F.col(size).desc(), F.col(key)).limit(n_total).select(
        key, F.lit(True).alias("is_top_total"))
    top_rat = cur.orderBy(F.col(ratio).desc(), F.col(key)).limit(n_ratio).select(
        key, F.lit(True).alias("_top_ratio"))
    out = cur.join(F.broadcast(top_tot), key, "left").join(F.broadcast(top_rat), key, "left")
    return out.select(
        *cur.columns,
        F.coalesce("is_top_total", F.lit(False)).alias("is_top_total"),
        (F.coalesce("_top_ratio", F.lit(False)) & ~F.coalesce("is_top_total", F.lit(False))).alias("is_top_ratio"),
    )
