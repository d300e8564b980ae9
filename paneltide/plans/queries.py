"""Registered queries (see plans.catalog). Each block: the Spark plan from
library operators, then its SQL twin for the oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneltide.plans import layers, proxy
from paneltide.plans.catalog import cte, register
from paneltide.session import scratch_path
from paneltide.sources.bronze import append_bronze
from paneltide.sources.contracts import GOLD, SILVER

SILVER_MIN_YEAR = 1996
STG_MIN_YEAR = 1997

# ---------------------------------------------------------------------------
# Shared SQL: proxy panels and layers (same definitions as plans.proxy and
# plans.layers).
# ---------------------------------------------------------------------------
_MONEY = "CAST({} AS DECIMAL(18,2))"
_ISO = "'N' || lpad(CAST({} AS VARCHAR), 2, '0')"


def _msum(col: str, cond: str | None = None) -> str:
    v = _MONEY.format(col)
    if cond:
        v = f"CASE WHEN {cond} THEN {v} END"
    return f"CAST(SUM({v}) AS DOUBLE)"


cte("p_emissions", [], f"""
SELECT n.n_name AS country,
       {_ISO.format('n.n_nationkey')} AS iso_code,
       CAST(year(o.o_orderdate) AS INTEGER) AS year,
       {_msum('o.o_totalprice')} AS co2,
       {_msum('o.o_totalprice')} / COUNT(DISTINCT o.o_custkey) AS co2_per_capita,
       {_msum('o.o_totalprice', "o.o_orderpriority = '1-URGENT'")} AS coal_co2,
       {_msum('o.o_totalprice', "o.o_orderpriority = '2-HIGH'")} AS oil_co2,
       {_msum('o.o_totalprice', "o.o_orderpriority = '3-MEDIUM'")} AS gas_co2,
       {_msum('o.o_totalprice', "o.o_orderpriority = '4-NOT SPECIFIED'")} AS flaring_co2,
       {_msum('o.o_totalprice', "o.o_orderpriority = '5-LOW'")} AS cement_co2,
       CAST(NULL AS DOUBLE) AS co2_growth_prct,
       CAST(COUNT(*) AS DOUBLE) AS primary_energy_consumption,
       {_msum('o.o_totalprice', "o.o_orderstatus = 'F'")} AS gdp,
       CAST(COUNT(DISTINCT o.o_custkey) AS BIGINT) AS population,
       {_msum('o.o_totalprice', "o.o_orderstatus = 'O'")} AS methane,
       {_msum('o.o_totalprice', "o.o_orderstatus = 'P'")} AS nitrous_oxide,
       CAST(NULL AS DOUBLE) AS total_ghg,
       '{proxy.INGESTED_AT}' AS _ingested_at,
       '{proxy.SOURCE_ORDERS}' AS _source_url
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, n.n_nationkey, year(o.o_orderdate)
""")

cte("p_indicators", [], f"""
SELECT n.n_name AS country_name,
       CAST(year(l.l_shipdate) AS INTEGER) AS year,
       100 * {_msum('l.l_extendedprice', "l.l_returnflag = 'R'")} / {_msum('l.l_extendedprice')} AS gdp_growth_pct,
       100 * {_msum('l.l_discount')} / COUNT(*) AS urban_population_pct,
       100 * {_msum('l.l_tax')} / COUNT(*) AS manufacturing_pct_gdp,
       {_ISO.format('n.n_nationkey')} AS iso_code,
       '{proxy.INGESTED_AT}' AS _ingested_at,
       '{proxy.SOURCE_LINEITEM}' AS _source_url
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
GROUP BY n.n_name, n.n_nationkey, year(l.l_shipdate)
HAVING COUNT(DISTINCT l.l_suppkey) >= 2
""")

cte("p_event", [], f"""
SELECT {_ISO.format('n_nationkey')} AS iso_code, n_name AS country,
       CAST(1996 + n_regionkey AS INTEGER) AS ratification_year
FROM nation WHERE n_regionkey > 0
""")

cte("p_silver", ["p_emissions", "p_indicators", "p_event"], f"""
SELECT e.iso_code, e.country, CAST(e.year AS INTEGER) AS year, e.co2, e.co2_per_capita,
       e.co2_growth_prct AS co2_growth_pct, e.coal_co2, e.oil_co2, e.gas_co2, e.cement_co2,
       e.flaring_co2, e.total_ghg, e.methane, e.nitrous_oxide, e.primary_energy_consumption,
       CAST(e.population AS DOUBLE) AS population, e.gdp,
       i.gdp_growth_pct, i.urban_population_pct, i.manufacturing_pct_gdp,
       v.ratification_year,
       CASE WHEN v.ratification_year IS NOT NULL AND e.year >= v.ratification_year
            THEN TRUE ELSE FALSE END AS paris_treated,
       CAST(CASE WHEN v.ratification_year IS NOT NULL
                 THEN greatest(0, e.year - v.ratification_year) ELSE 0 END AS INTEGER)
           AS years_since_ratification,
       e._ingested_at, e._source_url
FROM p_emissions e
LEFT JOIN p_indicators i ON e.iso_code = i.iso_code AND e.year = i.year
LEFT JOIN p_event v ON e.iso_code = v.iso_code
WHERE e.iso_code IS NOT NULL AND e.year >= {SILVER_MIN_YEAR} AND (e.co2 IS NULL OR e.co2 >= 0)
""")

# Staging: the Silver columns without provenance, the name spelt out.
_STG_COLUMNS = ["year", "iso_code", "country AS country_name",
                *[f.name for f in SILVER.fields if f.name not in ("year", "iso_code", "country", "_ingested_at", "_source_url")]]
cte("p_stg", ["p_silver"], f"""
SELECT {', '.join(_STG_COLUMNS)} FROM p_silver WHERE year >= {STG_MIN_YEAR} AND coalesce(iso_code, '') <> ''
""")

# Gold: each column of its StructType is a Silver column but for these.
_GOLD_FROM = {"population": "round(population)", "gdp_growth_rate": "gdp_growth_pct",
              **{f"{fuel}_pct": f"CASE WHEN co2 > 0 THEN {fuel}_co2 / co2 END" for fuel in ("coal", "oil", "gas", "cement")}}
_SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
_GOLD_COLUMNS = [f"CAST({_GOLD_FROM.get(f.name, f.name)} AS {_SQL_TYPE[f.dataType.simpleString()]}) AS {f.name}"
                 for f in GOLD.fields if f.name != "_built_at"]
cte("p_gold", ["p_silver"], f"""
SELECT {', '.join(_GOLD_COLUMNS)} FROM p_silver WHERE iso_code IS NOT NULL AND year IS NOT NULL
""")

# Year on year: the value before is found once, change and percent follow.
cte("p_change", ["p_stg"], """
SELECT *, co2 - before AS change, 100 * ((co2 - before) / nullif(before, 0)) AS pct
FROM (SELECT *, lag(co2) OVER by_year AS before FROM p_stg WINDOW by_year AS (PARTITION BY iso_code ORDER BY year)) s
""")
_MART_ROUNDED = {"co2": "co2", "co2_per_capita": "co2_per_capita", "before": "co2_prev_year", "change": "co2_yoy_change", "pct": "co2_yoy_pct"}
cte("p_mart", ["p_change"], f"""
SELECT year, iso_code, country_name, {', '.join(f'round({c}, 3) AS {name}' for c, name in _MART_ROUNDED.items())},
       CASE WHEN abs(pct) > 10 THEN CASE WHEN pct > 0 THEN 'high_growth' ELSE 'high_decline' END ELSE 'stable' END
         AS emissions_trend_label
FROM p_change
""")


# ---------------------------------------------------------------------------
# Spark builders shared by the queries
# ---------------------------------------------------------------------------
def silver(spark, sf):
    return layers.build_silver(proxy.emissions(spark, sf), proxy.indicators(spark, sf),
                               proxy.events_dim(spark, sf), min_year=SILVER_MIN_YEAR)


def staged(spark, sf):
    return layers.stg(silver(spark, sf), min_year=STG_MIN_YEAR, loaded_at=False)


def gold(spark, sf):
    return layers.gold_features(silver(spark, sf), built_at=False)


# ---------------------------------------------------------------------------
# Layers
# ---------------------------------------------------------------------------
@register("silver_panel", ["p_silver"], "SELECT * FROM p_silver")
def q_silver_panel(spark, sf):
    return silver(spark, sf)


OLD_DAY, NEW_DAY = "2024-01-01", "2024-01-02"
NEW_STAMP = "2024-01-02T00:00:00.000000+00:00"
RETRACTED, INVALID = "N05", "N03"


@register("silver_snapshots", ["p_silver"], f"""
SELECT * REPLACE ('{NEW_STAMP}' AS _ingested_at) FROM p_silver WHERE iso_code NOT IN ('{RETRACTED}', '{INVALID}')
""")
def q_silver_snapshots(spark, sf):
    """Silver from a directory with two snapshots, of which one day is read; the newer one lacks a key of the older and
    has made another key's values invalid."""
    e = proxy.emissions(spark, sf)
    co2 = F.when(F.col("iso_code") == INVALID, F.lit(-1.0)).otherwise(F.col("co2"))
    new = e.where(F.col("iso_code") != RETRACTED).withColumn("co2", co2).withColumn("_ingested_at", F.lit(NEW_STAMP))
    path = scratch_path(spark, "emissions")
    append_bronze(e, path, OLD_DAY)
    append_bronze(new, path, NEW_DAY)
    return layers.build_silver(path, proxy.indicators(spark, sf), proxy.events_dim(spark, sf), min_year=SILVER_MIN_YEAR)


@register("stg_panel", ["p_stg"], "SELECT * FROM p_stg")
def q_stg_panel(spark, sf):
    return staged(spark, sf)


@register("gold_features", ["p_gold"], "SELECT * FROM p_gold")
def q_gold_features(spark, sf):
    return gold(spark, sf)


@register("mart_country_emissions", ["p_mart"], "SELECT * FROM p_mart")
def q_mart_country_emissions(spark, sf):
    return layers.mart_country_emissions(staged(spark, sf))

