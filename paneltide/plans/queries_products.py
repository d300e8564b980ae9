"""Registered queries: sources, filters, data products, rankings and
profiles (S5 S7 P1 F5-F7 J7 A1-A11 A18 A19 T1-T6 W8 W11 W12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from paneltide.functions.exprs import money, parse_codes, scale
from paneltide.operators import aggregates as agg
from paneltide.operators import filters as flt
from paneltide.operators import ranking as rk
from paneltide.operators.joins import broadcast_if_small, validate_keys
from paneltide.operators.projection import select_available
from paneltide.operators.windows import dedup, rank_order, running_total
from paneltide.plans import proxy
from paneltide.plans.catalog import cte, register
from paneltide.plans.queries import gold, silver
from paneltide.session import table
from paneltide.session import scratch_path
from paneltide.sources.bronze import append_bronze, normalise_indicators, read_latest, stamp
from paneltide.sources.contracts import SILVER

KPI_YEAR = 2000
GROWTH_Y0, GROWTH_Y1, GROWTH_MIN_END_MT = 1996, 2000, 10.0
EMISSIONS_REQUEST = (1997, 2000, " n01, N03 ,,n05 ,N07")
KEY_REQUEST = "N01, n02, xx9, N99,"
AVAILABLE = ["iso_code", "country", "year", "co2", "gdp", "energy_per_capita", "population"]
# proxy aggregate lists: the region and world rows are the "aggregates" among
# the nation rows; each layer catches some of them
PROXY_AGG_NAMES = ["World", "AFRICA", "ASIA"]
PROXY_AGG_CODES = ["R1", "WLD"]
PROXY_AGG_PATTERNS = ["EAST", "(GCP)", "EURO"]
CORR_COLS = [f.name for f in SILVER.fields if f.dataType.simpleString() in ("int", "bigint", "double")]


_ISO_SQL = "'N' || lpad(CAST({} AS VARCHAR), 2, '0')"
_MSUM_SQL = "CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


def _sql_list(xs) -> str:
    return ", ".join("'" + x + "'" for x in xs)


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
SNAP1 = ("2024-01-01", "2024-01-01T00:00:00.000000+00:00")
SNAP2 = ("2024-01-02", "2024-01-02T00:00:00.000000+00:00")


def _two_snapshots(spark, sf):
    """orders landed twice: a full snapshot, then a revised one without the
    pending ('P') orders."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    s1 = stamp(o, proxy.SOURCE_ORDERS, SNAP1[1]).withColumn("ingestion_date", F.to_date(F.lit(SNAP1[0])))
    s2 = stamp(o.where(F.col("o_orderstatus") != "P"), proxy.SOURCE_ORDERS, SNAP2[1]) \
        .withColumn("ingestion_date", F.to_date(F.lit(SNAP2[0])))
    return s1.unionByName(s2)


cte("p_snapshots", [], f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       '{SNAP1[1]}' AS _ingested_at, '{proxy.SOURCE_ORDERS}' AS _source_url,
       DATE '{SNAP1[0]}' AS ingestion_date
FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       '{SNAP2[1]}' AS _ingested_at, '{proxy.SOURCE_ORDERS}' AS _source_url,
       DATE '{SNAP2[0]}' AS ingestion_date
FROM orders WHERE o_orderstatus <> 'P'
""")


@register("latest_snapshot", ["p_snapshots"],
          "SELECT * FROM p_snapshots WHERE ingestion_date = (SELECT max(ingestion_date) FROM p_snapshots)")
def q_latest_snapshot(spark, sf):
    """Both snapshots land in a directory, of which the newest day is read."""
    path, both = scratch_path(spark, "orders"), _two_snapshots(spark, sf)
    for day, _ in (SNAP1, SNAP2):
        append_bronze(both.where(F.col("ingestion_date") == day).drop("ingestion_date"), path, day)
    return read_latest(spark, path)


@register("latest_per_key", ["p_snapshots"], """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, _ingested_at, _source_url, ingestion_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_orderkey
                                   ORDER BY ingestion_date DESC, _ingested_at DESC) AS rn
      FROM p_snapshots) t
WHERE rn = 1
""")
def q_latest_per_key(spark, sf):
    return dedup(_two_snapshots(spark, sf), ["o_orderkey"], ["ingestion_date", "_ingested_at"], keep="last")


def _raw_indicators(spark, sf):
    """Indicator rows as an upstream feed delivers them: a name (countries and
    regional aggregates mixed), the year as text, one value."""
    li = table(spark, sf, "lineitem")
    per_supp = li.groupBy("l_suppkey", F.year("l_shipdate").alias("yr")).agg(
        F.sum(money("l_discount")).alias("disc"), F.count(F.lit(1)).alias("n"))
    sup = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    nat = proxy._nations(spark, sf)
    reg = table(spark, sf, "region")
    j = (per_supp.join(sup, per_supp["l_suppkey"] == sup["s_suppkey"])
         .join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(broadcast_if_small(reg), F.col("n_regionkey") == F.col("r_regionkey")))

    def level(name_col):
        g = j.groupBy(F.col(name_col).alias("country"), "yr").agg(
            F.sum("disc").alias("disc"), F.sum("n").alias("n"))
        return g.select("country", F.col("yr").cast("string").alias("date"),
                        (F.lit(100) * F.col("disc").cast("double") / F.col("n")).alias("SP.URB.TOTL.IN.ZS"))

    return level("n_name").unionByName(level("r_name"))


cte("p_raw_indicators", [], """
  SELECT n.n_name AS country, CAST(year(l.l_shipdate) AS VARCHAR) AS date,
         100 * CAST(SUM(CAST(l.l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS v
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY n.n_name, year(l.l_shipdate)
  UNION ALL
  SELECT r.r_name, CAST(year(l.l_shipdate) AS VARCHAR),
         100 * CAST(SUM(CAST(l.l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*)
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY r.r_name, year(l.l_shipdate)
""")


@register("indicator_normalise", ["p_raw_indicators"], """
SELECT raw.country AS country_name, raw.v AS urban_population_pct,
       TRY_CAST(raw.date AS INTEGER) AS year, 'N' || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS iso_code
FROM p_raw_indicators raw JOIN nation n ON raw.country = n.n_name
WHERE TRY_CAST(raw.date AS INTEGER) IS NOT NULL
""")
def q_indicator_normalise(spark, sf):
    lookup = table(spark, sf, "nation").select(
        F.col("n_name").alias("name"), proxy.iso_code(F.col("n_nationkey")).alias("id"))
    return normalise_indicators(_raw_indicators(spark, sf), lookup,
                                renames={"SP.URB.TOTL.IN.ZS": "urban_population_pct"})


@register("select_available", ["p_emissions"],
          "SELECT iso_code, country, year, co2, gdp, population FROM p_emissions")
def q_select_available(spark, sf):
    return select_available(proxy.emissions(spark, sf), AVAILABLE)[0]


def _country_table(spark, sf):
    """A country x year table as statistics offices publish it: one row per
    nation and year with regional and world aggregate rows mixed in
    (name, code, year, value = order value). The orders are folded per
    customer and year inside each map task first; the three levels are one
    grouping-sets aggregation (one Expand, one shuffle of partial sums)."""
    o = table(spark, sf, "orders")
    per_cust = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(money("o_totalprice")).alias("v"))
    cust = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nat = proxy._nations(spark, sf)
    reg = broadcast_if_small(table(spark, sf, "region").select("r_regionkey", "r_name"))
    j = (per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"])
         .join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(reg, F.col("n_regionkey") == F.col("r_regionkey")))
    keys = ["n_nationkey", "n_name", "r_regionkey", "r_name", "year"]
    g = j.groupingSets([keys, ["r_regionkey", "r_name", "year"], ["year"]], *keys).agg(
        F.sum("v").alias("v"), F.grouping_id().alias("_lvl"))
    nation_row, region_row = F.col("_lvl") == 0, F.col("_lvl") == 3
    return g.select(
        F.when(nation_row, F.col("n_name")).when(region_row, F.col("r_name"))
         .otherwise(F.lit("World")).alias("country_name"),
        F.when(nation_row, proxy.iso_code(F.col("n_nationkey")))
         .when(region_row, F.concat(F.lit("R"), F.col("r_regionkey").cast("string")))
         .otherwise(F.lit("WLD")).alias("country_code"),
        F.col("year").cast("int").alias("year"),
        F.col("v").cast("double").alias("value"),
    )


cte("p_country_table", [], f"""
SELECT n.n_name AS country_name, {_ISO_SQL.format('n.n_nationkey')} AS country_code,
       CAST(year(o.o_orderdate) AS INTEGER) AS year, {_MSUM_SQL} AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, n.n_nationkey, year(o.o_orderdate)
UNION ALL
SELECT r.r_name, 'R' || CAST(r.r_regionkey AS VARCHAR), CAST(year(o.o_orderdate) AS INTEGER), {_MSUM_SQL}
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name, r.r_regionkey, year(o.o_orderdate)
UNION ALL
SELECT 'World', 'WLD', CAST(year(o.o_orderdate) AS INTEGER), {_MSUM_SQL}
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY year(o.o_orderdate)
""")


@register("drop_aggregates", ["p_country_table"], f"""
SELECT country_name, country_code, year, value FROM p_country_table
WHERE NOT (country_name IS NULL
           OR coalesce(country_name IN ({_sql_list(PROXY_AGG_NAMES)}), false)
           OR coalesce(country_code IN ({_sql_list(PROXY_AGG_CODES)}), false)
           OR {' OR '.join(f"coalesce(contains(country_name, '{p}'), false)" for p in PROXY_AGG_PATTERNS)})
""")
def q_drop_aggregates(spark, sf):
    return flt.drop_aggregates(_country_table(spark, sf), "country_name", "country_code",
                               PROXY_AGG_NAMES, PROXY_AGG_CODES, PROXY_AGG_PATTERNS)


# ---------------------------------------------------------------------------
# Data products over the Gold table
# ---------------------------------------------------------------------------
@register("countries", ["p_gold"], "SELECT DISTINCT country, iso_code FROM p_gold")
def q_countries(spark, sf):
    return agg.countries(gold(spark, sf))


@register("metadata", ["p_gold"], """
SELECT min(year) AS min_year, max(year) AS max_year,
       count(DISTINCT iso_code) AS total_countries, count(*) AS n_rows FROM p_gold
""")
def q_metadata(spark, sf):
    return agg.metadata(gold(spark, sf), "iso_code", "year")


@register("emissions", ["p_gold"], f"""
SELECT country, iso_code, year, round(co2, 3) AS co2 FROM p_gold
WHERE year BETWEEN {EMISSIONS_REQUEST[0]} AND {EMISSIONS_REQUEST[1]}
  AND iso_code IN ('N01', 'N03', 'N05', 'N07')
ORDER BY country, year
""")
def q_emissions(spark, sf):
    y0, y1, codes = EMISSIONS_REQUEST
    df = flt.year_range(gold(spark, sf), "year", y0, y1)
    df = flt.keys_in(df, "iso_code", parse_codes(codes))
    return df.select("country", "iso_code", "year", F.round("co2", 3).alias("co2")).orderBy("country", "year")


@register("validate_keys", ["p_gold"], """
SELECT code FROM (VALUES ('N01'), ('N02'), ('XX9'), ('N99')) AS req(code)
WHERE code NOT IN (SELECT iso_code FROM p_gold)
""")
def q_validate_keys(spark, sf):
    req = spark.range(1).select(F.explode(parse_codes(KEY_REQUEST)).alias("code"))
    known = gold(spark, sf).select(F.col("iso_code").alias("code"))
    return validate_keys(req, known, "code")


@register("top_n", ["p_gold"], """
SELECT iso_code, country, year, co2 FROM p_gold
WHERE year = (SELECT max(year) FROM p_gold) AND co2 IS NOT NULL
ORDER BY co2 DESC, iso_code LIMIT 5
""")
def q_top_n(spark, sf):
    return rk.top_n(gold(spark, sf), "iso_code", "year", "co2", 5).select("iso_code", "country", "year", "co2")


@register("top_n_history", ["p_gold"], """
SELECT iso_code, country, year, co2 FROM p_gold
WHERE iso_code IN (SELECT iso_code FROM p_gold
                   WHERE year = (SELECT max(year) FROM p_gold) AND co2 IS NOT NULL
                   ORDER BY co2 DESC, iso_code LIMIT 5)
""")
def q_top_n_history(spark, sf):
    g = gold(spark, sf)
    return rk.top_n_history(g, "iso_code", "year", "co2", 5).select("iso_code", "country", "year", "co2")


@register("preview", ["p_gold"], """
SELECT country, iso_code, year, round(co2, 2) AS co2 FROM p_gold
WHERE year = (SELECT max(year) FROM p_gold)
ORDER BY co2 DESC NULLS LAST, iso_code LIMIT 50
""")
def q_preview(spark, sf):
    return rk.preview(gold(spark, sf), "iso_code", "year", "co2", ["country", "iso_code", "year", "co2"])


@register("bubble", ["p_gold"], """
SELECT iso_code, country, year, co2 / 1000000 AS co2_mt, co2_per_capita, population,
       r_tot <= 10 AS is_top_total, (r_rat <= 5 AND NOT r_tot <= 10) AS is_top_ratio
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY co2 DESC, iso_code) AS r_tot,
                ROW_NUMBER() OVER (ORDER BY co2_per_capita DESC, iso_code) AS r_rat
      FROM p_gold WHERE year = (SELECT max(year) FROM p_gold)
        AND co2 IS NOT NULL AND co2_per_capita IS NOT NULL AND population IS NOT NULL) r
""")
def q_bubble(spark, sf):
    g = gold(spark, sf).select("iso_code", "country", "year",
                               scale("co2", 1e-6).alias("co2_mt"), "co2_per_capita", "population")
    return rk.bubble(g, "iso_code", "year", "co2_mt", "co2_per_capita",
                     complete=["co2_mt", "co2_per_capita", "population"])


_GROWTH_SQL = f"""
SELECT iso_code, start_value, end_value,
       (end_value - start_value) / NULLIF(start_value, 0) * 100 AS growth_pct
FROM (SELECT iso_code,
             max(CASE WHEN year = {GROWTH_Y0} THEN co2 / 1000000 END) AS start_value,
             max(CASE WHEN year = {GROWTH_Y1} THEN co2 / 1000000 END) AS end_value
      FROM p_gold WHERE year IN ({GROWTH_Y0}, {GROWTH_Y1}) GROUP BY iso_code) w
WHERE start_value IS NOT NULL AND end_value IS NOT NULL AND end_value > {GROWTH_MIN_END_MT}
  AND (end_value - start_value) / NULLIF(start_value, 0) IS NOT NULL
"""
cte("p_growth", ["p_gold"], _GROWTH_SQL)


def _growth(spark, sf):
    g = gold(spark, sf).withColumn("co2", scale("co2", 1e-6))
    return rk.growth(g, "iso_code", "year", "co2", GROWTH_Y0, GROWTH_Y1, GROWTH_MIN_END_MT)


@register("growth", ["p_growth"], """
SELECT iso_code, start_value, end_value, round(growth_pct, 3) AS growth_pct FROM p_growth
""")
def q_growth(spark, sf):
    return _growth(spark, sf).withColumn("growth_pct", F.round("growth_pct", 3))


@register("movers", ["p_growth"], """
SELECT iso_code, start_value, end_value, round(growth_pct, 3) AS growth_pct, side,
       CAST(ROW_NUMBER() OVER (PARTITION BY side ORDER BY CASE WHEN side = 'grower' THEN -growth_pct
                                                          ELSE growth_pct END, iso_code) AS INTEGER) AS rank
FROM (SELECT *, 'grower' AS side FROM (SELECT * FROM p_growth ORDER BY growth_pct DESC, iso_code LIMIT 5)
      UNION ALL
      SELECT *, 'decliner' AS side FROM (SELECT * FROM p_growth ORDER BY growth_pct ASC, iso_code LIMIT 5)) u
""")
def q_movers(spark, sf):
    return rk.movers(_growth(spark, sf), "iso_code", 5).withColumn("growth_pct", F.round("growth_pct", 3))


@register("kpi_total_yoy", ["p_gold"], f"""
SELECT {KPI_YEAR} AS year, round(total, 3) AS total, round(prev_total, 3) AS prev_total,
       round(CASE WHEN prev_total > 0 THEN (total - prev_total) / prev_total * 100 ELSE 0.0 END, 3) AS yoy_pct,
       top_emitter, n_keys
FROM (SELECT coalesce(sum(CASE WHEN year = {KPI_YEAR} THEN co2 END), 0.0) AS total,
             coalesce(sum(CASE WHEN year = {KPI_YEAR - 1} THEN co2 END), 0.0) AS prev_total,
             arg_max(CASE WHEN year = {KPI_YEAR} THEN country END,
                     CASE WHEN year = {KPI_YEAR} THEN co2 END) AS top_emitter,
             count(DISTINCT CASE WHEN year = {KPI_YEAR} THEN iso_code END) AS n_keys
      FROM p_gold WHERE year IN ({KPI_YEAR}, {KPI_YEAR - 1})) a
""")
def q_kpi_total_yoy(spark, sf):
    k = agg.kpi(gold(spark, sf), "iso_code", "country", "year", "co2", KPI_YEAR)
    return k.select("year", *[F.round(c, 3).alias(c) for c in ["total", "prev_total", "yoy_pct"]],
                    "top_emitter", "n_keys")


@register("share_of_total", ["p_gold"], """
SELECT iso_code, year, co2, round(group_total, 3) AS group_total,
       round(100.0 * co2 / NULLIF(group_total, 0), 3) AS share_pct
FROM (SELECT iso_code, year, co2, sum(co2) OVER (PARTITION BY year) AS group_total FROM p_gold) t
""")
def q_share_of_total(spark, sf):
    g = gold(spark, sf).select("iso_code", "year", "co2")
    s = agg.share_of_total(g, ["year"], "co2")
    return s.select("iso_code", "year", "co2", F.round("group_total", 3).alias("group_total"),
                    F.round("share_pct", 3).alias("share_pct"))


cte("p_totals", ["p_gold"], """
SELECT iso_code, sum(CAST(co2 AS DECIMAL(18,2))) AS total_dec FROM p_gold GROUP BY iso_code
""")


def _totals(spark, sf):
    g = gold(spark, sf)
    return g.groupBy("iso_code").agg(F.sum(money("co2")).alias("total_dec"))


@register("totals_ranked", ["p_totals"], """
SELECT iso_code, CAST(total_dec AS DOUBLE) AS total,
       ROW_NUMBER() OVER (ORDER BY total_dec DESC, iso_code) AS rank
FROM p_totals
""")
def q_totals_ranked(spark, sf):
    r = rank_order(_totals(spark, sf), [F.col("total_dec").desc(), F.col("iso_code")], "rank")
    return r.select("iso_code", F.col("total_dec").cast("double").alias("total"), "rank")


@register("running_total", ["p_totals"], """
SELECT iso_code, CAST(total_dec AS DOUBLE) AS total,
       ROW_NUMBER() OVER (ORDER BY total_dec DESC, iso_code) AS rank,
       CAST(SUM(total_dec) OVER (ORDER BY total_dec DESC, iso_code
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM p_totals
""")
def q_running_total(spark, sf):
    r = running_total(_totals(spark, sf), [F.col("total_dec").desc(), F.col("iso_code")],
                      "total_dec", out="running_dec", rank_col="rank")
    return r.select("iso_code", F.col("total_dec").cast("double").alias("total"), "rank",
                    F.col("running_dec").cast("double").alias("running_total"))


# ---------------------------------------------------------------------------
# Profiles over Silver / Gold
# ---------------------------------------------------------------------------
def _null_profile_sql() -> str:
    parts = []
    for f in SILVER.fields:
        parts.append(
            f"SELECT '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS dtype, "
            f"count(*) FILTER (WHERE {f.name} IS NULL) AS nulls, "
            f"round(100.0 * count(*) FILTER (WHERE {f.name} IS NULL) / count(*), 3) AS null_pct FROM p_silver")
    return "\nUNION ALL\n".join(parts)


@register("null_profile", ["p_silver"], _null_profile_sql())
def q_null_profile(spark, sf):
    return agg.null_profile(silver(spark, sf))


@register("describe", ["p_silver"], """
SELECT stat, round(value, 3) AS value FROM (
  SELECT 'count' AS stat, CAST(count(co2) AS DOUBLE) AS value FROM p_silver
  UNION ALL SELECT 'mean', avg(co2) FROM p_silver
  UNION ALL SELECT 'std', stddev_samp(co2) FROM p_silver
  UNION ALL SELECT 'min', min(co2) FROM p_silver
  UNION ALL SELECT 'max', max(co2) FROM p_silver
  UNION ALL SELECT 'q25', quantile_cont(co2, 0.25) FROM p_silver
  UNION ALL SELECT 'q50', quantile_cont(co2, 0.5) FROM p_silver
  UNION ALL SELECT 'q75', quantile_cont(co2, 0.75) FROM p_silver) d
""")
def q_describe(spark, sf):
    return agg.describe(silver(spark, sf), "co2").withColumn("value", F.round("value", 3))


def _corr_sql() -> str:
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 3) AS corr FROM p_silver"
             for a, b in agg.as_pairs(CORR_COLS)]
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", ["p_silver"], _corr_sql())
def q_corr_matrix(spark, sf):
    return agg.corr_matrix(silver(spark, sf), CORR_COLS)


@register("layer_report", ["p_silver"], """
SELECT count(*) AS n_rows, 25 AS n_columns, count(DISTINCT iso_code) AS n_keys,
       min(year) AS min_year, max(year) AS max_year FROM p_silver
""")
def q_layer_report(spark, sf):
    return agg.layer_report(silver(spark, sf), "iso_code", "year")


@register("coverage", ["p_gold"], """
SELECT total_rows, treated_rows,
       round(100.0 * treated_rows / NULLIF(total_rows, 0), 2) AS treated_pct,
       (total_rows > 0 AND CAST(treated_rows AS DOUBLE) / total_rows >= 0.01) AS passed
FROM (SELECT count(*) AS total_rows, count(*) FILTER (WHERE paris_treated = TRUE) AS treated_rows
      FROM p_gold) s
""")
def q_coverage(spark, sf):
    return agg.coverage(gold(spark, sf))
