"""Global order statistics without funnelling rows into one task.

A window with no PARTITION BY (global rank, running total, ntile) makes Spark
move every row into a single task. Here the rows are range-partitioned by the
sort key instead; each task numbers its own rows, the per-task row counts
(one small row per partition) give each partition its offset, and the offset
is added back. The sorted, numbered rows are checkpointed first so that the
counting pass and the numbering pass see exactly the same partitions even if
an executor is lost and a stage is recomputed.

Quantiles per key sort the distinct values with their counts, which partial
aggregation makes in the map tasks: a value that half the rows share is one
row, so ties never meet in one partition. Quantiles of a whole column need no
order at all, see ``selection``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.session import reliable_checkpoint

_LOW33 = (1 << 33) - 1

def global_positions(df: DataFrame, order: list[Column], pos_col: str = "_pos",
                     value_col: str | None = None, cum_col: str | None = None,
                     total_col: str | None = None) -> DataFrame:
    """Add the 1-based position of each row in ``order`` (must be a total order,
    i.e. end with a unique key). Optionally add the running total of
    ``value_col`` (exact for decimal and integer input) in ``cum_col``, and the
    row count of the whole input in ``total_col``."""
    ranked = (
        df.orderBy(*order)
        .withColumn("_pid", F.spark_partition_id())
        # record number inside the partition = low 33 bits, in sorted order
        .withColumn("_loc", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    )
    if value_col is not None:
        w_local = Window.partitionBy("_pid").orderBy("_loc").rowsBetween(Window.unboundedPreceding, 0)
        ranked = ranked.withColumn("_lcum", F.sum(value_col).over(w_local))
    ranked = reliable_checkpoint(ranked)

    aggs = [F.count(F.lit(1)).alias("_n")]
    if value_col is not None:
        aggs.append(F.sum(value_col).alias("_s"))
    per_part = ranked.groupBy("_pid").agg(*aggs)
    # one row per partition: bounded by the partition count, so the window
    # below and the broadcast are small by construction
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per_part.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    keep = ["_pid", "_off"]
    if total_col is not None:
        offs = offs.withColumn(total_col, F.sum("_n").over(Window.partitionBy()))
        keep.append(total_col)
    if value_col is not None:
        offs = offs.withColumn("_soff", F.sum("_s").over(before))
        keep.append("_soff")
    out = ranked.join(F.broadcast(offs.select(*keep)), "_pid")
    out = out.withColumn(pos_col, F.col("_off") + F.col("_loc") + 1)
    if value_col is not None:
        zero = F.lit(0).cast(ranked.schema[value_col].dataType)
        out = out.withColumn(cum_col, F.coalesce(F.col("_soff"), zero) + F.col("_lcum"))
    return out.drop("_pid", "_loc", "_off", "_soff", "_lcum")


def ntile_expr(pos: Column, n: Column, k: int) -> Column:
    """SQL NTILE(k) from a 1-based position and the row count: the first
    n % k buckets hold one row more."""
    q = F.floor(n / k).cast("long")
    r = (n % k).cast("long")
    big = r * (q + 1)
    return F.when(pos <= big, F.floor((pos - 1) / (q + 1)) + 1).otherwise(
        r + F.floor(F.try_divide(pos - big - 1, q)) + 1
    ).cast("int")


def _around(cum: Column, n: Column, h: Column) -> Column:
    """Does the run of equal values that ends at position ``cum`` (of ``n``
    rows) hold the row that a quantile at 0-based place ``h`` rounds to?"""
    return (cum - n <= h) & (h < cum)


def keyed_positions(df: DataFrame, key: str, order: list[Column], pos_col: str = "_pos") -> DataFrame:
    """1-based position of each row inside its ``key`` group in ``order``,
    for groups of any size (one key may hold a third of all rows).

    The rows are range-partitioned by (key, order), so a huge group spans
    several tasks; each task numbers its rows, and the offset of a (task,
    key) pair is the row count of that key in earlier tasks - a window over a
    table with one row per (task, key), at most one row per task for any one
    key. NULL keys form one group, as in a window PARTITION BY."""
    ranked = (
        df.orderBy(F.col(key), *order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_loc", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    )
    # fixes the partitions and numbering for both passes (and for recovery)
    ranked = reliable_checkpoint(ranked)
    per = ranked.groupBy("_pid", key).agg(F.count(F.lit(1)).alias("_n"), F.min("_loc").alias("_first"))
    before = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), "_first",
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # joined on (task, key): a hot key's rows are spread over its tasks
    out = ranked.join(offs, (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey")))
    return (out.withColumn(pos_col, F.col("_off") + F.col("_loc") - F.col("_first") + 1)
               .drop("_pid", "_loc", "_opid", "_okey", "_first", "_off"))


def keyed_quantile(df: DataFrame, key: str, col: str, prob: float) -> DataFrame:
    """Exact linearly interpolated ``prob`` quantile of ``col`` per key (SQL
    percentile_cont), for groups of any size: the key's distinct values with
    their counts (aggregated in the map tasks) are range-partitioned by (key,
    value), so a hot key and a hot value both spread; counts are cumulated in
    each task, and a (task, key) pair's offset is that key's count in earlier
    tasks. NULL values are ignored. One row per key: (key, value)."""
    vals = (df.where(F.col(col).isNotNull()).groupBy(F.col(key), F.col(col).alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))
    ranked = vals.orderBy(F.col(key), "_v").withColumn("_pid", F.spark_partition_id())
    ranked = reliable_checkpoint(ranked)
    per = ranked.groupBy("_pid", key).agg(F.sum("_c").alias("_n"))
    mine = Window.partitionBy(key)
    before = mine.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), F.sum("_n").over(mine).alias("_total"))
    # only pairs that hold one of the two places around the target go on
    h = (F.col("_total") - 1) * F.lit(float(prob))
    offs = offs.withColumns({"_lo": F.floor(h), "_hi": F.ceil(h), "_frac": h - F.floor(h)})
    out = ranked.join(offs, (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey")))
    local = Window.partitionBy("_pid", key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    out = out.withColumn("_cum", F.col("_off") + F.sum("_c").over(local))
    v = lambda place: F.max(F.when(_around(F.col("_cum"), F.col("_c"), F.col(place)), F.col("_v")))
    q = out.groupBy(key).agg(v("_lo").alias("_vlo"), v("_hi").alias("_vhi"), F.first("_frac").alias("_frac"))
    return q.select(key, (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("value"))
