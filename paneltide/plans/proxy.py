"""Proxy panels over the driver's TPC-H-style tables.

The driver tables hold no emissions, so the panel operators run on panels
that Spark derives from them (the same definitions are written in SQL in
``plans.catalog`` for the DuckDB oracle):

* emissions  - nation x order year from orders/customer: money sums by order
               priority stand in for the fuel components, distinct customers
               for population.
* indicators - nation x ship year from lineitem/supplier, published only where
               at least two suppliers report (so the left join has misses).
* events     - one event year per nation: 1996 + region key; region 0 never.
* month      - nation x order month, y = order value (forecasting input).
* user_day   - events by user x day over the user's own span (gap filling).

Every fact table is folded by a partial aggregation on its own key before
the join that maps it to a nation, so a customer, supplier or user holding a
third of all rows is reduced inside each map task before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.functions.exprs import money
from paneltide.operators.joins import broadcast_if_small
from paneltide.session import table

INGESTED_AT = "2024-01-01T00:00:00.000000+00:00"
SOURCE_ORDERS = "tpch://orders"
SOURCE_LINEITEM = "tpch://lineitem"

# order priority -> fuel component of the proxy emissions
COMPONENTS = {
    "coal_co2": "1-URGENT",
    "oil_co2": "2-HIGH",
    "gas_co2": "3-MEDIUM",
    "flaring_co2": "4-NOT SPECIFIED",
    "cement_co2": "5-LOW",
}


def iso_code(nationkey: Column) -> Column:
    """N00 .. N24."""
    return F.concat(F.lit("N"), F.lpad(nationkey.cast("string"), 2, "0"))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return broadcast_if_small(n)


def _nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """iso_code -> nation name, broadcast behind the row-count check (a
    broadcast join keeps the other side's partitioning)."""
    n = table(spark, sf_dir, "nation").select(iso_code(F.col("n_nationkey")).alias("iso_code"), "n_name")
    return broadcast_if_small(n)


def emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped emissions panel (one snapshot)."""
    o = table(spark, sf_dir, "orders")
    amt = money("o_totalprice")
    pr, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    comp = [F.sum(F.when(pr == v, amt)).alias(k) for k, v in COMPONENTS.items()]
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(amt).alias("co2"), *comp,
        F.sum(F.when(st == "F", amt)).alias("gdp"),
        F.sum(F.when(st == "O", amt)).alias("methane"),
        F.sum(F.when(st == "P", amt)).alias("nitrous_oxide"),
        F.count(F.lit(1)).alias("n_orders"),
    )
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = ["co2", *COMPONENTS, "gdp", "methane", "nitrous_oxide", "n_orders"]
    # grouped by the panel key itself, so the output is hash-partitioned on
    # (iso_code, year) and every later step keyed on it (de-duplication, the
    # indicator join, per-key windows) reuses this shuffle
    by_nation = (
        per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
        .groupBy(iso_code(F.col("c_nationkey")).alias("iso_code"), "year")
        .agg(*[F.sum(c).alias(c) for c in sums],
             # one row per (customer, year) after the pre-aggregation, so a
             # row count is the number of distinct customers
             F.count(F.lit(1)).alias("population"))
    )
    n = _nation_names(spark, sf_dir)
    j = by_nation.join(n, "iso_code")
    dbl = {c: F.col(c).cast("double") for c in ["co2", *COMPONENTS, "gdp", "methane", "nitrous_oxide"]}
    return j.select(
        F.col("n_name").alias("country"),
        "iso_code",
        F.col("year").cast("int").alias("year"),
        dbl["co2"].alias("co2"),
        (dbl["co2"] / F.col("population")).alias("co2_per_capita"),
        *[dbl[c].alias(c) for c in COMPONENTS],
        F.lit(None).cast("double").alias("co2_growth_prct"),
        F.col("n_orders").cast("double").alias("primary_energy_consumption"),
        dbl["gdp"].alias("gdp"),
        F.col("population").cast("bigint").alias("population"),
        dbl["methane"].alias("methane"),
        dbl["nitrous_oxide"].alias("nitrous_oxide"),
        F.lit(None).cast("double").alias("total_ghg"),
        F.lit(INGESTED_AT).alias("_ingested_at"),
        F.lit(SOURCE_ORDERS).alias("_source_url"),
    )


def indicators(spark: SparkSession, sf_dir: str, min_reporters: int = 2) -> DataFrame:
    """Bronze-shaped indicator table: nation x ship year, published where at
    least ``min_reporters`` suppliers contributed."""
    li = table(spark, sf_dir, "lineitem")
    ext = money("l_extendedprice")
    per_supp = li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.sum(ext).alias("ext"),
        F.sum(F.when(F.col("l_returnflag") == "R", ext)).alias("ext_r"),
        F.sum(money("l_discount")).alias("disc"),
        F.sum(money("l_tax")).alias("tax"),
        F.count(F.lit(1)).alias("n"),
    )
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    by_nation = (
        per_supp.join(sup, per_supp["l_suppkey"] == sup["s_suppkey"])
        .groupBy(iso_code(F.col("s_nationkey")).alias("iso_code"), "year")
        .agg(*[F.sum(c).alias(c) for c in ["ext", "ext_r", "disc", "tax", "n"]],
             F.count(F.lit(1)).alias("n_suppliers"))
        .where(F.col("n_suppliers") >= min_reporters)
    )
    n = _nation_names(spark, sf_dir)
    j = by_nation.join(n, "iso_code")
    return j.select(
        F.col("n_name").alias("country_name"),
        F.col("year").cast("int").alias("year"),
        (F.lit(100) * F.col("ext_r").cast("double") / F.col("ext").cast("double")).alias("gdp_growth_pct"),
        (F.lit(100) * F.col("disc").cast("double") / F.col("n")).alias("urban_population_pct"),
        (F.lit(100) * F.col("tax").cast("double") / F.col("n")).alias("manufacturing_pct_gdp"),
        "iso_code",
        F.lit(INGESTED_AT).alias("_ingested_at"),
        F.lit(SOURCE_LINEITEM).alias("_source_url"),
    )


def events_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event (ratification) year per nation: 1996 + region key; region 0 has
    no event, so it is the never-treated group."""
    n = table(spark, sf_dir, "nation")
    return n.where(F.col("n_regionkey") > 0).select(
        iso_code(F.col("n_nationkey")).alias("iso_code"),
        F.col("n_name").alias("country"),
        (F.lit(1996) + F.col("n_regionkey")).cast("int").alias("ratification_year"),
    )


def month_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x month: iso_code, ds (first day of month), y (order value)."""
    o = table(spark, sf_dir, "orders")
    per_cust = o.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("ds")).agg(
        F.sum(money("o_totalprice")).alias("y"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    by_nation = (per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
                 .groupBy(iso_code(F.col("c_nationkey")).alias("iso_code"), "ds")
                 .agg(F.sum("y").alias("y")))
    return by_nation.select(
        "iso_code",
        F.col("ds").cast("date").alias("ds"),
        F.col("y").cast("double").alias("y"),
    )


def user_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events by user x day, from each user's first to last day; empty days in
    between have NULL y and 0 counts. A user adds only the days of their own
    span, generated with ``sequence``."""
    ev = table(spark, sf_dir, "events")
    daily = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.sum(money("value")).cast("double").alias("y"),
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("event_type") == "error", 1)).alias("err"),
    )
    grid = daily.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        "user_id", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    out = grid.join(daily, ["user_id", "day"], "left")
    return out.select(
        "user_id", "day", "y",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.coalesce("err", F.lit(0)).cast("bigint").alias("err"),
    )
