"""Silver and Gold layers and the SQL-model marts, as lazy DataFrame plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.exprs import share, treated, trend_label, years_since
from paneltide.operators import filters as flt
from paneltide.operators.joins import attach, attach_dim
from paneltide.operators.windows import dedup, yoy
from paneltide.sources.bronze import PARTITION_COL, latest_snapshot, read_latest
from paneltide.sources.contracts import GOLD, SILVER, SILVER_RENAMES

INDICATOR_COLS = ["gdp_growth_pct", "urban_population_pct", "manufacturing_pct_gdp"]


def conform(df: DataFrame, schema=SILVER, renames: dict[str, str] | None = None) -> DataFrame:
    """Canonical typed projection driven by a StructType; missing optional
    columns become typed NULLs, renamed ones are read under their old name."""
    renames = SILVER_RENAMES if renames is None else renames
    back = {new: old for old, new in renames.items()}
    present = set(df.columns)
    exprs = []
    for f in schema.fields:
        src = back.get(f.name, f.name)
        src = src if src in present else f.name
        value = f"`{src}`" if src in present else "NULL"
        exprs.append(f"CAST({value} AS {f.dataType.simpleString()}) AS `{f.name}`")
    # one projection built from SQL text: a single call instead of one
    # expression object per column
    return df.selectExpr(*exprs)


def _snapshot(source: DataFrame | str) -> DataFrame:
    """The newest snapshot, taken before any row filter: a row that the newest
    snapshot withdrew or made invalid doesn't come back from an older one. Of
    a snapshot directory, given by its path, only that day is scanned."""
    if isinstance(source, str):
        return read_latest(SparkSession.active(), source)
    return latest_snapshot(source) if PARTITION_COL in source.columns else source


def _newest(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key of a snapshot (D4: never let snapshots fan out)."""
    order = [c for c in ("_ingested_at",) if c in df.columns]
    return dedup(df, keys, order, keep="last")


def build_silver(emissions: DataFrame | str, indicators: DataFrame | str, events: DataFrame | str,
                 min_year: int = 1960, key: str = "iso_code", t: str = "year",
                 event_col: str = "ratification_year") -> DataFrame:
    """Silver panel: newest snapshot of each source (a frame, or the path of a
    snapshot directory), filter, de-duplicate each
    source on its key, two left joins, treatment columns, 25-column projection.

    Each source is de-duplicated before the joins, so the emissions side comes
    out hash-partitioned on (key, year) and the indicator join reuses that
    partitioning; the event dimension (one row per key) is broadcast when its
    row count allows.
    """
    e = flt.drop_null_keys(_snapshot(emissions), [key])
    e = flt.min_year(e, t, min_year)
    e = flt.non_negative(e, "co2")
    e = _newest(e, [key, t])
    indicators, events = _snapshot(indicators), _snapshot(events)
    ind = _newest(indicators.select(key, t, *INDICATOR_COLS, *[c for c in ("_ingested_at",) if c in indicators.columns]),
                  [key, t]).select(key, t, *INDICATOR_COLS)
    ev = _newest(events.select(key, event_col, *[c for c in ("_ingested_at",) if c in events.columns]), [key]).select(key, event_col)
    panel = attach(e, ind, [key, t])
    panel = attach_dim(panel, ev, [key])
    panel = (panel.withColumn("paris_treated", treated(t, event_col))
                  .withColumn("years_since_ratification", years_since(t, event_col)))
    return conform(panel)


def stg(silver: DataFrame, min_year: int = 1960, loaded_at: bool = True) -> DataFrame:
    """Staging projection (typed, renamed, 24 columns with the
    load timestamp)."""
    df = silver.where((F.col("year") >= min_year) & F.col("iso_code").isNotNull()
                      & (F.col("iso_code") != ""))
    cols = [
        F.col("year").cast("int").alias("year"), "iso_code",
        F.col("country").alias("country_name"),
        F.col("co2").cast("double").alias("co2"),
        F.col("co2_per_capita").cast("double").alias("co2_per_capita"),
        "co2_growth_pct", "coal_co2", "oil_co2", "gas_co2", "cement_co2", "flaring_co2",
        "primary_energy_consumption", "gdp", "population", "methane", "nitrous_oxide",
        "total_ghg", "gdp_growth_pct", "urban_population_pct", "manufacturing_pct_gdp",
        "ratification_year", "paris_treated", "years_since_ratification",
    ]
    if loaded_at:
        cols.append(F.current_timestamp().alias("_loaded_at"))
    return df.select(*cols)


def mart_country_emissions(staged: DataFrame) -> DataFrame:
    """W1-W3 + P8 + P9: year-on-year change per key with a trend label.

    One shuffle on the key; the four LAG uses share one window spec, so
    Catalyst computes them in a single sort.
    """
    y = yoy(staged, "iso_code", "year", "co2", prefix="co2")
    cols = [
        "year", "iso_code", "country_name",
        F.round("co2", 3).alias("co2"),
        F.round("co2_per_capita", 3).alias("co2_per_capita"),
        F.round("co2_prev_year", 3).alias("co2_prev_year"),
        F.round("co2_yoy_change", 3).alias("co2_yoy_change"),
        F.round("co2_yoy_pct", 3).alias("co2_yoy_pct"),
        trend_label("co2_yoy_pct").alias("emissions_trend_label"),
    ]
    if "_loaded_at" in staged.columns:
        cols.append("_loaded_at")
    return y.select(*cols)


def gold_features(silver: DataFrame, built_at: bool = True) -> DataFrame:
    """The 17-column feature table. Population is rounded before
    the BIGINT cast (engines differ on plain double -> integer casts).
    No COALESCE: a failed join shows up as a NULL-check breach downstream."""
    df = silver.where(F.col("iso_code").isNotNull() & F.col("year").isNotNull())
    cols = [
        "iso_code", "country", F.col("year").cast("int").alias("year"),
        F.col("co2").cast("double").alias("co2"),
        F.col("co2_per_capita").cast("double").alias("co2_per_capita"),
        F.col("gdp").cast("double").alias("gdp"),
        F.round("population").cast("bigint").alias("population"),
        F.col("primary_energy_consumption").cast("double").alias("primary_energy_consumption"),
        F.col("gdp_growth_pct").cast("double").alias("gdp_growth_rate"),
        share("coal_co2", "co2").alias("coal_pct"),
        share("oil_co2", "co2").alias("oil_pct"),
        share("gas_co2", "co2").alias("gas_pct"),
        share("cement_co2", "co2").alias("cement_pct"),
        F.col("ratification_year").cast("int").alias("ratification_year"),
        F.col("paris_treated").cast("boolean").alias("paris_treated"),
        F.col("years_since_ratification").cast("int").alias("years_since_ratification"),
    ]
    if built_at:
        cols.append(F.current_timestamp().alias("_built_at"))
    out = df.select(*cols)
    assert not built_at or [f.name for f in out.schema.fields] == [f.name for f in GOLD.fields]
    return out
