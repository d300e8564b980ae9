"""Row filters and predicates (F-operators). Each is a plain ``where`` that
Catalyst pushes into the parquet scan when the column comes from a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The aggregate-region lists used to tell real countries from
# regional / income-group aggregates (names, codes, and name substrings).
# They must equal the reference's lists for the same rows to be removed.
# ---------------------------------------------------------------------------
AGGREGATE_NAMES = [
    "World", "Arab World", "Central Europe and the Baltics",
    "East Asia & Pacific", "East Asia & Pacific (excluding high income)",
    "East Asia & Pacific (IDA & IBRD countries)",
    "Europe & Central Asia", "Europe & Central Asia (excluding high income)",
    "Europe & Central Asia (IDA & IBRD countries)",
    "European Union", "Euro area",
    "Latin America & Caribbean", "Latin America & Caribbean (excluding high income)",
    "Latin America & the Caribbean (IDA & IBRD countries)",
    "Middle East & North Africa", "Middle East & North Africa (excluding high income)",
    "Middle East & North Africa (IDA & IBRD countries)",
    "North America", "South Asia", "South Asia (IDA & IBRD)",
    "Sub-Saharan Africa", "Sub-Saharan Africa (excluding high income)",
    "Sub-Saharan Africa (IDA & IBRD countries)",
    "Africa Eastern and Southern", "Africa Western and Central",
    "High income", "Low & middle income", "Low income", "Lower middle income",
    "Middle income", "Upper middle income", "OECD members",
    "IDA & IBRD total", "IBRD only", "IDA total", "IDA blend", "IDA only",
    "Heavily indebted poor countries (HIPC)",
    "Least developed countries: UN classification",
    "Fragile and conflict affected situations",
    "Early-demographic dividend", "Late-demographic dividend",
    "Pre-demographic dividend", "Post-demographic dividend",
    "Small states", "Pacific island small states", "Caribbean small states",
    "Other small states", "Not classified",
    "Africa", "Asia", "Asia (excl. China and India)", "Europe",
    "Europe (excl. EU-27)", "Europe (excl. EU-28)",
    "European Union (27)", "European Union (28)",
    "North America (excl. USA)", "Oceania", "South America",
    "Non-OECD (GCP)", "OECD (GCP)",
    "High-income countries", "Low-income countries",
    "Lower-middle-income countries", "Upper-middle-income countries",
]
AGGREGATE_CODES = [
    "ARB", "CSS", "EAP", "EAS", "ECA", "ECS", "EMU", "EUU",
    "FCS", "HIC", "HPC", "IBD", "IBT", "IDA", "IDX", "INX",
    "LAC", "LCN", "LDC", "LIC", "LMC", "LMY", "LTE", "MEA",
    "MIC", "MNA", "NAC", "OED", "OSS", "PRE", "PSS", "PST",
    "SAS", "SSA", "SSF", "SST", "TEA", "TEC", "TLA", "TMN",
    "TSA", "TSS", "UMC", "WLD",
    "OWID_AFR", "OWID_ASI", "OWID_EUR", "OWID_EUN", "OWID_NAM",
    "OWID_OCE", "OWID_SAM", "OWID_WRL", "OWID_HIC", "OWID_LIC",
    "OWID_LMC", "OWID_UMC", "OWID_NON_OECD", "OWID_OECD",
]
AGGREGATE_PATTERNS = [
    "income", "dividend", "IBRD", "IDA", "excluding", "excl.",
    "(GCP)", "European Union", "OECD",
]


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    """F1."""
    return df.dropna(subset=cols)


def min_year(df: DataFrame, year_col: str, y: int) -> DataFrame:
    """F2."""
    return df.where(F.col(year_col) >= y)


def non_negative(df: DataFrame, col: str) -> DataFrame:
    """an unknown value is kept, only a negative one is dropped."""
    return df.where(F.col(col).isNull() | (F.col(col) >= 0))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """F4."""
    return df.where(F.col(col) != "")


def year_range(df: DataFrame, year_col: str, start: int, end: int) -> DataFrame:
    """inclusive."""
    return df.where(F.col(year_col).between(start, end))


def keys_in(df: DataFrame, key: str, codes: Column | list[str] | None) -> DataFrame:
    """optional key filter. ``codes`` may be a Python list (IN list) or an
    array Column such as ``parse_codes(text)`` (constant-folded by Catalyst)."""
    if codes is None:
        return df
    if isinstance(codes, list):
        return df.where(F.col(key).isin(codes))
    return df.where(F.array_contains(codes, F.col(key)))


def is_aggregate(name: Column, code: Column, names: list[str], codes: list[str],
                 patterns: list[str]) -> Column:
    """True for an aggregate row: listed name, listed code, NULL name, or a
    name containing one of the substrings (plain, case-sensitive, not regex)."""
    hit = name.isNull()
    if names:
        hit = hit | F.coalesce(name.isin(names), F.lit(False))
    if codes:
        hit = hit | F.coalesce(code.isin(codes), F.lit(False))
    for p in patterns:
        hit = hit | F.coalesce(name.contains(p), F.lit(False))
    return hit


def drop_aggregates(df: DataFrame, name_col: str, code_col: str,
                    names: list[str] = AGGREGATE_NAMES, codes: list[str] = AGGREGATE_CODES,
                    patterns: list[str] = AGGREGATE_PATTERNS) -> DataFrame:
    """Three-layer exclusion. A NULL code is not in the code list
    (kept by that layer), as with pandas ``~isin``."""
    return df.where(~is_aggregate(F.col(name_col), F.col(code_col), names, codes, patterns))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """F8."""
    return df.dropna(subset=cols)


def significant(df: DataFrame, col: str, threshold: float) -> DataFrame:
    """strictly above the threshold."""
    return df.where(F.col(col) > threshold)


def min_history(df: DataFrame, key: str, n: int, value_col: str | None = None):
    """Per-key point count against a minimum.

    Returns ``(eligible_rows, key_status)``: the rows of keys with at least
    ``n`` points, and one row per key with its count and an ``eligible`` flag
    (the reference raises for a short series; we report it instead).
    """
    base = df if value_col is None else df.where(F.col(value_col).isNotNull())
    counts = base.groupBy(key).agg(F.count(F.lit(1)).alias("n_points"))
    status = counts.withColumn("eligible", F.col("n_points") >= n)
    ok = status.where("eligible").select(key)
    return base.join(ok, key, "left_semi"), status


def before(df: DataFrame, time_col: str, cutoff) -> DataFrame:
    """training cut-off, strictly before."""
    return df.where(F.col(time_col) < cutoff)
