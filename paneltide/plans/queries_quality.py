"""Quality suites per layer (Q1-Q13) and their registered queries.

The suites are the reference's expectations (fixed values: thresholds and
column lists). Each suite is evaluated in one aggregation pass by
operators.quality.run_suite; the SQL twin below evaluates the same checks
one SELECT per check.
"""

from __future__ import annotations

from paneltide.operators import quality as q
from paneltide.plans import layers, proxy
from paneltide.plans.catalog import cte, register
from paneltide.plans.queries import STG_MIN_YEAR, silver
from paneltide.session import reliable_checkpoint
from paneltide.sources.contracts import BRONZE_CONTRACT, BRONZE_EMISSIONS, GOLD, GOLD_CONTRACT, SILVER, SILVER_CONTRACT

# The reference's raw-emissions suite.
RAW_SUITE = [
    q.exists("country"), q.exists("year"), q.exists("iso_code"), q.exists("co2"),
    q.not_null("country"), q.not_null("year"),
    q.between("year", 1750, 2030),
    q.row_count(10001, None),
]

# The reference's conformed-Silver suite (>= 150 keys included).
SILVER_SUITE = [
    q.row_count(10000, 20000), q.column_count(25),
    q.not_null("iso_code"), q.not_null("year"), q.between("year", 1960, 2024),
    q.exists("co2"), q.exists("country"),
    q.exists("gdp_growth_pct"), q.exists("urban_population_pct"), q.exists("manufacturing_pct_gdp"),
    q.exists("ratification_year"), q.exists("paris_treated"), q.exists("years_since_ratification"),
    q.distinct_at_least("iso_code", 150),
]

# The SQL-model tests of the Gold table, the staging model and
# the treated-coverage test (>= 1 % of rows treated).
GOLD_SUITE = [
    q.unique(["iso_code", "year"]),
    q.not_null("iso_code"), q.not_null("year"), q.not_null("paris_treated"),
    q.not_null("years_since_ratification"),
    q.accepted("paris_treated", [True, False]),
    q.share_at_least("treated_coverage", "paris_treated = TRUE", 0.01),
]
STG_SUITE = [
    q.unique(["iso_code", "year"]),
    q.not_null("iso_code"), q.not_null("year"), q.not_null("country_name"),
    q.not_null("co2", where="iso_code IS NOT NULL", severity="warn"),
]

EMISSIONS_COLUMNS = ["country", "iso_code", "year", "co2", "co2_per_capita", "coal_co2", "oil_co2",
                     "gas_co2", "flaring_co2", "cement_co2", "co2_growth_prct",
                     "primary_energy_consumption", "gdp", "population", "methane", "nitrous_oxide",
                     "total_ghg", "_ingested_at", "_source_url"]


# ---------------------------------------------------------------------------
# SQL twin of run_suite
# ---------------------------------------------------------------------------
def _s(x) -> str:
    return "NULL" if x is None else "'" + str(x).replace("'", "''") + "'"


def suite_sql(table: str, suite: str, checks: list[q.Check], types: dict[str, str]) -> str:
    parts = []
    head = "SELECT '{suite}' AS suite, {label} AS check_name, CAST({col} AS VARCHAR) AS column_name, " \
           "'{sev}' AS severity, "
    for ch in checks:
        h = head.format(suite=suite, label=_s(ch.label), col=_s(ch.column), sev=ch.severity)
        cond = f"({ch.where}) AND " if ch.where else ""
        if ch.kind in ("exists", "type", "column_count"):
            if ch.kind == "exists":
                ok, obs = ch.column in types, int(ch.column in types)
            elif ch.kind == "type":
                ok = types.get(ch.column) == ch.params["type"]
                obs = int(ok)
            else:
                ok, obs = len(types) == ch.params["n"], len(types)
            parts.append(h + f"{'TRUE' if ok else 'FALSE'} AS passed, CAST({obs} AS BIGINT) AS observed")
            continue
        if ch.kind == "unique":
            cols = ", ".join(ch.params["cols"])
            parts.append(h + "count(*) = 0 AS passed, CAST(count(*) AS BIGINT) AS observed FROM "
                         f"(SELECT {cols} FROM {table} GROUP BY {cols} HAVING count(*) > 1) d")
            continue
        c = ch.column
        if c is not None and c not in types:
            parts.append(h + "FALSE AS passed, CAST(NULL AS BIGINT) AS observed")
            continue
        if ch.kind == "not_null":
            obs = f"count(*) FILTER (WHERE {cond}{c} IS NULL)"
            passed = "o = 0"
        elif ch.kind == "between":
            lo, hi = ch.params["lo"], ch.params["hi"]
            bad = " OR ".join(([f"{c} < {lo}"] if lo is not None else []) + ([f"{c} > {hi}"] if hi is not None else []))
            obs = f"count(*) FILTER (WHERE {cond}{c} IS NOT NULL AND ({bad}))"
            passed = "o = 0"
        elif ch.kind == "row_count":
            obs = "count(*)"
            conds = ([f"o >= {ch.params['lo']}"] if ch.params["lo"] is not None else []) + \
                    ([f"o <= {ch.params['hi']}"] if ch.params["hi"] is not None else [])
            passed = " AND ".join(conds) or "TRUE"
        elif ch.kind == "distinct_at_least":
            obs = f"count(DISTINCT {c})"
            passed = f"o >= {ch.params['n']}"
        elif ch.kind == "accepted":
            vals = ", ".join(str(v).upper() if isinstance(v, bool) else _s(v) for v in ch.params["values"])
            obs = f"count(*) FILTER (WHERE {cond}{c} IS NOT NULL AND {c} NOT IN ({vals}))"
            passed = "o = 0"
        elif ch.kind == "share_at_least":
            obs = f"floor(10000.0 * count(*) FILTER (WHERE {ch.params['predicate']}) / NULLIF(count(*), 0))"
            passed = f"coalesce(o >= {round(ch.params['share'] * 10000)}, FALSE)"
        elif ch.kind == "custom":
            obs = f"count(*) FILTER (WHERE {ch.params['failing']})"
            passed = "o = 0"
        else:
            raise ValueError(ch.kind)
        parts.append(h + f"{passed} AS passed, o AS observed FROM "
                     f"(SELECT CAST({obs} AS BIGINT) AS o FROM {table}) a")
    return "\nUNION ALL\n".join(parts)


def _types(schema, drop=()) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema.fields if f.name not in drop}


_EMISSION_TYPES = {c: t for c, t in _types(BRONZE_EMISSIONS).items() if c in EMISSIONS_COLUMNS}
_SILVER_TYPES = _types(SILVER)
_GOLD_TYPES = _types(GOLD)
_STG_TYPES = {c: "x" for c in ["year", "iso_code", "country_name", "co2"]}

BRONZE_ALL = RAW_SUITE + q.contract_checks(BRONZE_CONTRACT)
SILVER_ALL = SILVER_SUITE + q.contract_checks(SILVER_CONTRACT)
GOLD_ALL = GOLD_SUITE + q.contract_checks(GOLD_CONTRACT)
cte("p_gold_built", ["p_gold"], "SELECT *, now() AS _built_at FROM p_gold")


@register("quality_bronze", ["p_emissions"], suite_sql("p_emissions", "bronze", BRONZE_ALL, _EMISSION_TYPES))
def q_quality_bronze(spark, sf):
    return q.run_suite(reliable_checkpoint(proxy.emissions(spark, sf)), "bronze", BRONZE_ALL)


@register("quality_silver", ["p_silver"], suite_sql("p_silver", "silver", SILVER_ALL, _SILVER_TYPES))
def q_quality_silver(spark, sf):
    return q.run_suite(reliable_checkpoint(silver(spark, sf)), "silver", SILVER_ALL)


@register("quality_gold", ["p_gold_built", "p_stg"],
          suite_sql("p_gold_built", "gold", GOLD_ALL, _GOLD_TYPES) + "\nUNION ALL\n"
          + suite_sql("p_stg", "staging", STG_SUITE, _STG_TYPES))
def q_quality_gold(spark, sf):
    # both layers and all their checks read one copy of the panel
    panel = reliable_checkpoint(silver(spark, sf))
    return q.run_suite(layers.gold_features(panel), "gold", GOLD_ALL).unionByName(
        q.run_suite(layers.stg(panel, min_year=STG_MIN_YEAR, loaded_at=False), "staging", STG_SUITE))
