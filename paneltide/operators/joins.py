"""Joins (J-operators) and the size-checked broadcast used by all of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A dimension is broadcast only when it has at most this many rows and its
# measured size is within the byte bound. Beyond either, the join stays a
# shuffle join, which AQE may still turn into a broadcast from runtime
# statistics (spark.sql.autoBroadcastJoinThreshold).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024

# bytes per value of the fixed-width types (Spark's in-memory widths)
_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}
_ROW_OVERHEAD = 16


def _value_bytes(field) -> Column:
    """Bytes one value of ``field`` occupies: exact for strings and binaries
    (their length), the length of the JSON text for nested values (arrays,
    maps, structs; an over-estimate of their binary size), a fixed width for
    the other types."""
    name = field.dataType.simpleString()
    c = F.col(f"`{field.name}`")
    if name in ("string", "binary"):
        return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")
    if name.startswith(("array<", "map<", "struct<")):
        return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)).cast("long")
    return F.lit(_FIXED_WIDTH.get(name, 8)).cast("long")


def measure(dim: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a DataFrame as it is now, in one aggregation pass
    (partial sums in every task, one small merge). Nothing is remembered: what
    is at a path may have grown since it was measured last."""
    width = sum((_value_bytes(f) for f in dim.schema.fields), F.lit(_ROW_OVERHEAD).cast("long"))
    r = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def fits_broadcast(rows: int, size_bytes: int, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return rows <= max_rows and size_bytes <= max_bytes


def broadcast_if_small(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` only behind a size check: its row count and its
    measured size in bytes (string lengths included) must both be within the
    bounds. Otherwise the plain DataFrame is returned and Spark shuffles.
    Select the columns the join needs before calling, so only those are
    measured and shipped."""
    rows, size = measure(dim)
    return F.broadcast(dim) if fits_broadcast(rows, size, max_rows, max_bytes) else dim


def attach(panel: DataFrame, other: DataFrame, on: list[str], cols: list[str] | None = None) -> DataFrame:
    """Left equi-join on a (composite) key; keeps every panel row.

    The other side is selected down to key + wanted columns before the join
    so the scan reads only those columns.
    """
    if cols is not None:
        other = other.select(*on, *cols)
    return panel.join(other, on=on, how="left")


def attach_dim(panel: DataFrame, dim: DataFrame, on: list[str], cols: list[str] | None = None,
               max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left join of a dimension (one row per key), broadcast when small."""
    if cols is not None:
        dim = dim.select(*on, *cols)
    return panel.join(broadcast_if_small(dim, max_rows), on=on, how="left")


def lookup_inner(df: DataFrame, lookup: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Attach a code through a name lookup; rows without a match are dropped."""
    lk = broadcast_if_small(lookup)
    return df.join(lk, df[left_on] == lk[right_on], "inner")


def restrict(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Keep rows whose key is in a computed key set (left semi join)."""
    return df.join(keys.select(*on), on=on, how="left_semi")


def exclude(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Drop rows whose key is in a key set (left anti join, null-safe on the
    left: a NULL key never matches, so it is kept, as pandas ``~isin`` does)."""
    return df.join(keys.select(*on), on=on, how="left_anti")


def validate_keys(requested: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Requested codes that do not exist (empty result = all valid)."""
    return requested.join(known.select(key).distinct(), on=key, how="left_anti")


def align(forecast: DataFrame, actual: DataFrame, key: str, step: str = "step",
          by: list[str] | None = None) -> DataFrame:
    """Pair forecast and actual values by key and position; a series
    (key + ``by``, e.g. the method) whose two sides have different lengths is
    skipped, as the reference loop does."""
    by = by or []
    fn = forecast.groupBy(key, *by).agg(F.count(F.lit(1)).alias("_nf"))
    an = actual.groupBy(key).agg(F.count(F.lit(1)).alias("_na"))
    same = fn.join(an, key).where(F.col("_nf") == F.col("_na")).select(key, *by)
    return forecast.join(actual, on=[key, step], how="inner").join(same, [key, *by], "left_semi")


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate (global statistics) to every
    row. The aggregate is packed into one struct and read as a scalar
    subquery: no join at all, the subquery runs once per query (Spark reuses
    identical subqueries) and only its single row is shipped to the tasks.
    ``one_row`` must be a global aggregate, so it is one row by construction
    (a scalar subquery fails loudly on more)."""
    cols = one_row.columns
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_s")).scalar()
    return df.select("*", *[packed.getField(c).alias(c) for c in cols])
