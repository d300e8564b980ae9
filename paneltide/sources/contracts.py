"""Layer contracts: frozen StructTypes and the checks each layer must pass."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, L, D, B, TS = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampType())


def _schema(fields: list[tuple[str, T.DataType, bool]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Bronze emissions: 21 data fields + provenance (partition column added on read).
BRONZE_EMISSIONS = _schema([
    ("country", S, True), ("iso_code", S, True), ("year", I, False),
    ("co2", D, True), ("co2_per_capita", D, True), ("co2_per_gdp", D, True),
    ("coal_co2", D, True), ("oil_co2", D, True), ("gas_co2", D, True),
    ("cement_co2", D, True), ("flaring_co2", D, True), ("co2_growth_prct", D, True),
    ("primary_energy_consumption", D, True), ("energy_per_capita", D, True),
    ("gdp", D, True), ("population", L, True), ("share_global_co2", D, True),
    ("cumulative_co2", D, True), ("methane", D, True), ("nitrous_oxide", D, True),
    ("total_ghg", D, True), ("_ingested_at", S, False), ("_source_url", S, False),
])

BRONZE_INDICATORS = _schema([
    ("country_name", S, False), ("year", I, False), ("gdp_growth_pct", D, True),
    ("urban_population_pct", D, True), ("manufacturing_pct_gdp", D, True),
    ("iso_code", S, False), ("_ingested_at", S, False), ("_source_url", S, False),
])

RATIFICATIONS = _schema([
    ("iso_code", S, False), ("country", S, False), ("ratification_year", I, False),
    ("_ingested_at", S, False), ("_source_url", S, False),
])

# Silver panel: primary key (iso_code, year), 25 columns in this order.
SILVER = _schema([
    ("iso_code", S, False), ("country", S, True), ("year", I, False),
    ("co2", D, True), ("co2_per_capita", D, True), ("co2_growth_pct", D, True),
    ("coal_co2", D, True), ("oil_co2", D, True), ("gas_co2", D, True),
    ("cement_co2", D, True), ("flaring_co2", D, True), ("total_ghg", D, True),
    ("methane", D, True), ("nitrous_oxide", D, True),
    ("primary_energy_consumption", D, True), ("population", D, True), ("gdp", D, True),
    ("gdp_growth_pct", D, True), ("urban_population_pct", D, True),
    ("manufacturing_pct_gdp", D, True), ("ratification_year", I, True),
    ("paris_treated", B, False), ("years_since_ratification", I, False),
    ("_ingested_at", S, True), ("_source_url", S, True),
])
# Silver reads these bronze names under different silver names.
SILVER_RENAMES = {"co2_growth_prct": "co2_growth_pct"}

# Gold features: 17 columns (the build timestamp is last).
GOLD = _schema([
    ("iso_code", S, False), ("country", S, True), ("year", I, False),
    ("co2", D, True), ("co2_per_capita", D, True), ("gdp", D, True),
    ("population", L, True), ("primary_energy_consumption", D, True),
    ("gdp_growth_rate", D, True), ("coal_pct", D, True), ("oil_pct", D, True),
    ("gas_pct", D, True), ("cement_pct", D, True), ("ratification_year", I, True),
    ("paris_treated", B, False), ("years_since_ratification", I, False),
    ("_built_at", TS, False),
])


@dataclass
class Contract:
    """What a layer promises: columns, key, value ranges, size bounds."""

    name: str
    schema: T.StructType
    primary_key: list[str]
    not_null: list[str]
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    min_rows: int | None = None
    max_rows: int | None = None
    min_keys: int | None = None
    key: str | None = None
    accepted: dict[str, list] = field(default_factory=dict)


# The reference's quality thresholds per layer.
BRONZE_CONTRACT = Contract(
    name="bronze_emissions", schema=BRONZE_EMISSIONS, primary_key=[],
    not_null=["country", "year"],
    ranges={
        "year": (1750, 2030), "co2": (0, None), "co2_per_capita": (0, None), "co2_per_gdp": (0, None),
        "coal_co2": (0, None), "oil_co2": (0, None), "gas_co2": (0, None), "cement_co2": (0, None),
        "primary_energy_consumption": (0, None), "energy_per_capita": (0, None), "gdp": (0, None),
        "population": (0, None), "share_global_co2": (0, 100), "cumulative_co2": (0, None),
        "methane": (0, None), "nitrous_oxide": (0, None), "total_ghg": (0, None),
    },
    min_rows=10001,
)
SILVER_CONTRACT = Contract(
    name="silver_panel", schema=SILVER, primary_key=["iso_code", "year"],
    not_null=["iso_code", "year", "paris_treated", "years_since_ratification", "_ingested_at", "_source_url"],
    ranges={
        "year": (1960, 2024), "co2": (0, None), "co2_per_capita": (0, None), "coal_co2": (0, None),
        "oil_co2": (0, None), "gas_co2": (0, None), "cement_co2": (0, None), "flaring_co2": (0, None),
        "total_ghg": (0, None), "methane": (0, None), "nitrous_oxide": (0, None),
        "primary_energy_consumption": (0, None), "population": (0, None), "gdp": (0, None),
        "urban_population_pct": (0, 100), "manufacturing_pct_gdp": (0, 100),
        "ratification_year": (2015, 2030), "years_since_ratification": (0, None),
    },
    min_rows=10000, max_rows=20000, min_keys=150, key="iso_code",
)
GOLD_CONTRACT = Contract(
    name="gold_features", schema=GOLD, primary_key=["iso_code", "year"],
    not_null=["iso_code", "year", "paris_treated", "years_since_ratification", "_built_at"],
    ranges={
        "year": (1960, None), "co2": (0, None), "co2_per_capita": (0, None), "gdp": (0, None),
        "population": (0, None), "primary_energy_consumption": (0, None), "coal_pct": (0, 1),
        "oil_pct": (0, 1), "gas_pct": (0, 1), "cement_pct": (0, 1), "years_since_ratification": (0, None),
    },
    accepted={"paris_treated": [True, False]},
)
