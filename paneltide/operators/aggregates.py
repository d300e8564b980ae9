"""Aggregations (A-operators). Each profile is one ``agg`` pass (partial
aggregation in every task, one small final merge); wide results are turned
into long rows with ``stack`` instead of one job per column."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.functions.exprs import safe_div
from paneltide.operators.selection import quantiles


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def n_keys(df: DataFrame, key: str, alias: str = "n_keys") -> DataFrame:
    """A1."""
    return df.agg(F.count_distinct(key).alias(alias))


def metadata(df: DataFrame, key: str, t: str) -> DataFrame:
    """A1 + A2: time range, key count, row count in one pass."""
    return df.agg(
        F.min(t).alias("min_year"), F.max(t).alias("max_year"),
        F.count_distinct(key).alias("total_countries"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def countries(df: DataFrame, name: str = "country", key: str = "iso_code") -> DataFrame:
    """Distinct (name, code) pairs, sorted by name."""
    return df.select(name, key).distinct().orderBy(name, key)


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: per column: type, NULL count, NULL percent. One pass over the data."""
    cols = cols or df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)
    ]
    wide = df.agg(*aggs)
    parts = ", ".join(f"{_lit(c)}, {_lit(types[c])}, `_null_{i}`" for i, c in enumerate(cols))
    long = wide.select("_n", F.expr(f"stack({len(cols)}, {parts}) AS (column_name, dtype, nulls)"))
    return long.select(
        "column_name", "dtype", F.col("nulls").cast("bigint").alias("nulls"),
        F.round(F.try_divide(F.lit(100.0) * F.col("nulls"), F.col("_n")), 3).alias("null_pct"),
    )


def describe(df: DataFrame, col: str) -> DataFrame:
    """A4: count, mean, sample std, min, quartiles, max of one column (pandas
    ``describe``). Quartiles are exact (linear interpolation) and selected by
    counting passes, without a sort."""
    c = F.col(col)
    held = df.select(c).persist(StorageLevel.MEMORY_AND_DISK)  # one column, read by a few passes
    m = held.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
               F.min(c).alias("min"), F.max(c).alias("max")).first().asDict()
    m |= dict(zip(["q25", "q50", "q75"], quantiles(held, col, [0.25, 0.5, 0.75], m["count"])))
    held.unpersist()
    rows = [(k, None if v is None else float(v)) for k, v in m.items() if m["count"] or k[0] != "q"]
    return df.sparkSession.createDataFrame(rows, "stat string, value double")


def totals(df: DataFrame, key: str, m: str, alias: str = "total") -> DataFrame:
    """A5: group total (sort separately, e.g. with windows.rank_order)."""
    return df.groupBy(key).agg(F.sum(m).alias(alias))


def share_of_total(df: DataFrame, group: list[str], m: str, out: str = "share_pct") -> DataFrame:
    """Each row's share of its group's total (e.g. a country's share of
    the world total in a year). The totals are an aggregate joined back on the
    group key - never a window without a partition."""
    tot = df.groupBy(*group).agg(F.sum(m).alias("group_total"))
    return df.join(tot, group).withColumn(out, safe_div(F.lit(100.0) * F.col(m), F.col("group_total")))


def kpi(df: DataFrame, key: str, name: str, t: str, m: str, year: int) -> DataFrame:
    """A7 + A8: total in ``year``, change vs the year before (0 when that total
    is not > 0), top key by value, keys reporting. One pass over two years."""
    two = df.where(F.col(t).isin(year, year - 1))
    cur, prev = F.col(t) == year, F.col(t) == year - 1
    agg = two.agg(
        F.coalesce(F.sum(F.when(cur, F.col(m))), F.lit(0.0)).alias("total"),
        F.coalesce(F.sum(F.when(prev, F.col(m))), F.lit(0.0)).alias("prev_total"),
        F.max_by(F.when(cur, F.col(name)), F.when(cur, F.struct(F.col(m), F.col(name)))).alias("top_emitter"),
        F.count_distinct(F.when(cur, F.col(key))).alias("n_keys"),
    )
    return agg.select(
        F.lit(year).alias("year"), "total", "prev_total",
        F.when(F.col("prev_total") > 0,
               (F.col("total") - F.col("prev_total")) / F.col("prev_total") * 100)
        .otherwise(F.lit(0.0)).alias("yoy_pct"),
        "top_emitter", "n_keys",
    )


def coverage(df: DataFrame, flag: str = "paris_treated", min_share: float = 0.01) -> DataFrame:
    """Rows, flagged rows, percent, and whether the share reaches the
    minimum (the reference test fails on an empty table or a share < 1 %)."""
    a = df.agg(F.count(F.lit(1)).alias("total_rows"),
               F.count_if(F.col(flag) == F.lit(True)).alias("treated_rows"))
    return a.select(
        "total_rows", "treated_rows",
        F.round(safe_div(F.lit(100.0) * F.col("treated_rows"), F.col("total_rows")), 2).alias("treated_pct"),
        ((F.col("total_rows") > 0)
         & (F.col("treated_rows").cast("double") / F.col("total_rows") >= min_share)).alias("passed"),
    )


def corr_matrix(df: DataFrame, cols: list[str], digits: int = 3) -> DataFrame:
    """Pairwise-complete Pearson correlations, lower triangle, long form.
    All pairs in one aggregation pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
    wide = df.agg(*[F.corr(a, b).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"{_lit(a)}, {_lit(b)}, `_c{i}`" for i, (a, b) in enumerate(pairs))
    long = wide.select(F.expr(f"stack({len(pairs)}, {parts}) AS (col_a, col_b, corr)"))
    return long.withColumn("corr", F.round("corr", digits))


def error_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, population std, max, p95, p99 of a score column; exact
    percentiles by counting passes."""
    c = F.col(col)
    held = df.select(c).persist(StorageLevel.MEMORY_AND_DISK)  # one column, read by a few passes
    n, *m = held.agg(F.count(c), F.avg(c), F.stddev_pop(c), F.max(c)).first()
    row = [*m, *quantiles(held, col, [0.95, 0.99], n)]
    held.unpersist()
    schema = ", ".join(f"{k} double" for k in ("mean", "std", "max", "p95", "p99"))
    return df.sparkSession.createDataFrame([tuple(None if v is None else float(v) for v in row)], schema)


def layer_report(df: DataFrame, key: str, t: str) -> DataFrame:
    """Rows, columns, keys, time range."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(key).alias("n_keys"),
        F.min(t).alias("min_year"), F.max(t).alias("max_year"),
    )


def weighted_moments(df: DataFrame, feats: list[str], weight: str) -> DataFrame:
    """A13 core: weighted mean and population std per feature, long form.

    Rows of one weight share a state of count, mean and mean squared deviation
    from that mean, which rows update and tasks merge; the states of the
    weights (as many as a window has steps, so a few rows) are then merged
    around the common mean. So no digits are lost where values are large beside their spread,
    and the raw rows are read once. Rows without a value or a positive weight
    don't count; a feature without any is NULL. Only the last digits depend on
    the order in which states merge."""
    parts = ", ".join(f"{_lit(f)}, CAST(`{f}` AS DOUBLE)" for f in feats)
    long = df.select(F.col(weight).cast("double").alias("_w"), F.expr(f"stack({len(feats)}, {parts}) AS (feature, _x)"))
    long = long.where((F.col("_w") > 0) & F.col("_x").isNotNull())
    states = long.groupBy("feature", "_w").agg(F.count("*").alias("_n"), F.avg("_x").alias("_m"), F.var_pop("_x").alias("_v"))
    states = states.select("feature", "_m", "_v", (F.col("_w") * F.col("_n")).alias("_w"))
    own = Window.partitionBy("feature")
    states = states.withColumn("mean", F.sum(F.col("_w") * F.col("_m")).over(own) / F.sum("_w").over(own))
    off = F.col("_m") - F.col("mean")
    # what the rounding of the mean leaves is taken off again
    square = F.sum(F.col("_w") * (F.col("_v") + off * off)) / F.sum("_w") - F.pow(F.sum(F.col("_w") * off) / F.sum("_w"), F.lit(2.0))
    merged = states.groupBy("feature", "mean").agg(F.sqrt(F.greatest(F.lit(0.0), square)).alias("std"))
    names = df.sparkSession.createDataFrame([(f,) for f in feats], "feature string")
    return names.join(F.broadcast(merged), "feature", "left")  # one row for each feature


def as_pairs(cols: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[:i]]
