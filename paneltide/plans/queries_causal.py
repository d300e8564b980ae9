"""Registered queries: policy-effect estimators
on the Silver proxy panel; anomaly scorers M5/M7 on the user-day panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from paneltide.functions.exprs import verdict
from paneltide.operators import anomaly as an
from paneltide.operators import causal as cz
from paneltide.operators import windows as win
from paneltide.plans.catalog import cte, register
from paneltide.plans.queries import silver
from paneltide.plans.queries_timeseries import CUTOFF_DAY, FEATS, W, ffilled, zscored

OUTCOME = "co2_per_capita"
TREATMENT = "paris_treated"
CONTROLS = ["gdp", "population", "primary_energy_consumption"]
POST_YEAR = 1999
PLACEBO_SHIFT = 2
FAKE_YEAR = 1998
EST_COLS = ["estimator", "att", "se", "ci_lower", "ci_upper", "n_units", "n_obs", "status"]

cte("p_did", ["p_silver"], f"""
SELECT iso_code, year, {OUTCOME} AS y, CASE WHEN {TREATMENT} THEN 1.0 ELSE 0.0 END AS d
FROM p_silver WHERE {OUTCOME} IS NOT NULL AND iso_code IS NOT NULL AND year IS NOT NULL
""")
cte("p_did_bal", ["p_did"], """
SELECT * FROM p_did WHERE iso_code IN (
  SELECT iso_code FROM p_did GROUP BY iso_code
  HAVING count(DISTINCT year) = (SELECT count(DISTINCT year) FROM p_did))
""")


def _fe_sql(name: str, src: str, two_way: bool) -> str:
    def dm(c):
        if two_way:
            return (f"{c} - avg({c}) OVER (PARTITION BY iso_code) - avg({c}) OVER (PARTITION BY year) "
                    f"+ avg({c}) OVER ()")
        return f"{c} - avg({c}) OVER (PARTITION BY iso_code)"

    return f"""
SELECT '{name}' AS estimator, round(beta, 3) AS att, round(se, 3) AS se,
       round(beta - 1.96 * se, 3) AS ci_lower, round(beta + 1.96 * se, 3) AS ci_upper,
       g AS n_units, n AS n_obs, 'ok' AS status
FROM (SELECT beta, sqrt(CAST(g AS DOUBLE) / (g - 1) * (n - 1.0) / (n - 1) * meat) / sdd AS se, g, n
      FROM (SELECT beta, sdd, count(*) AS g, CAST(sum(ng) AS BIGINT) AS n, sum(s * s) AS meat
            FROM (SELECT iso_code, beta, sdd, sum(dt * (yt - beta * dt)) AS s, count(*) AS ng
                  FROM (SELECT *, sum(dt * yt) OVER () / sum(dt * dt) OVER () AS beta,
                               sum(dt * dt) OVER () AS sdd
                        FROM (SELECT iso_code, {dm('y')} AS yt, {dm('d')} AS dt FROM {src}) a) b
                  GROUP BY iso_code, beta, sdd) c
            GROUP BY beta, sdd) d) e
"""


def _est(df):
    return df.select("estimator", *[F.round(c, 3).alias(c) for c in ["att", "se", "ci_lower", "ci_upper"]],
                     "n_units", "n_obs", "status")


@register("post_dummy", ["p_silver"],
          f"SELECT iso_code, year, CAST(year >= {POST_YEAR} AS INTEGER) AS post FROM p_silver")
def q_post_dummy(spark, sf):
    return silver(spark, sf).select("iso_code", "year", cz.post_dummy_col("year", POST_YEAR).alias("post"))


def _twfe_balanced(spark, sf):
    s = cz.balance(silver(spark, sf).where(F.col(OUTCOME).isNotNull()), "iso_code", "year")
    return _est(cz.twfe(s, OUTCOME, TREATMENT, [], "iso_code", "year", estimator="twfe"))


cte("p_twfe", ["p_did_bal"], _fe_sql("twfe", "p_did_bal", True))


@register("twfe_balanced", ["p_twfe"], "SELECT * FROM p_twfe")
def q_twfe_balanced(spark, sf):
    return _twfe_balanced(spark, sf)


@register("unit_fe", ["p_did"], _fe_sql("unit_fe", "p_did", False))
def q_unit_fe(spark, sf):
    return _est(cz.twfe(silver(spark, sf), OUTCOME, TREATMENT, [], "iso_code", "year",
                        time_effects=False, estimator="unit_fe"))


@register("estimate_verdict", ["p_twfe"], """
SELECT estimator, att, ci_lower, ci_upper,
       CASE WHEN ci_upper < 0 THEN 'reduces' WHEN ci_lower > 0 THEN 'increases' ELSE 'inconclusive' END AS verdict
FROM p_twfe
""")
def q_estimate_verdict(spark, sf):
    r = _twfe_balanced(spark, sf)
    return r.select("estimator", "att", "ci_lower", "ci_upper", verdict("ci_lower", "ci_upper").alias("verdict"))


cte("p_cells", ["p_silver"], f"""
SELECT ratification_year AS cohort, year, avg({OUTCOME}) AS ybar, count(DISTINCT iso_code) AS n_units, count(*) AS n
FROM p_silver WHERE {OUTCOME} IS NOT NULL GROUP BY ratification_year, year
""")
cte("p_cohort_att", ["p_cells"], """
SELECT c.cohort, c.year, c.year - c.cohort AS rel_time, (c.ybar - b.ybar) - (nv.ybar - nb.ybar) AS att, c.n_units,
       CASE WHEN b.ybar IS NULL THEN 'no_base_period'
            WHEN nv.ybar IS NULL OR nb.ybar IS NULL THEN 'no_never_treated' ELSE 'ok' END AS status,
       c.n, b.n AS n_base, nv.n AS n_nev, nb.n AS n_nb
FROM p_cells c
LEFT JOIN p_cells b ON b.cohort = c.cohort AND b.year = c.cohort - 1
LEFT JOIN p_cells nv ON nv.cohort IS NULL AND nv.year = c.year
LEFT JOIN p_cells nb ON nb.cohort IS NULL AND nb.year = c.cohort - 1
WHERE c.cohort IS NOT NULL AND c.year <> c.cohort - 1
""")
# each unit's influence on each effect: its residuals over the sizes of the cells they enter
cte("p_cohort_influence", ["p_silver", "p_cells", "p_cohort_att"], f"""
SELECT a.cohort, a.year, a.n_units, e.iso_code,
       sum(CASE WHEN e.cohort IS NULL THEN -1 ELSE 1 END
           * (CASE WHEN e.year = a.year THEN e.e / (CASE WHEN e.cohort IS NULL THEN a.n_nev ELSE a.n END) ELSE 0 END
              - CASE WHEN e.year = a.cohort - 1 THEN e.e / (CASE WHEN e.cohort IS NULL THEN a.n_nb ELSE a.n_base END) ELSE 0 END)) AS psi
FROM p_cohort_att a
JOIN (SELECT s.iso_code, s.ratification_year AS cohort, s.year, s.{OUTCOME} - c.ybar AS e
      FROM p_silver s JOIN p_cells c ON c.cohort IS NOT DISTINCT FROM s.ratification_year AND c.year = s.year
      WHERE s.{OUTCOME} IS NOT NULL) e ON e.cohort = a.cohort OR e.cohort IS NULL
WHERE a.status = 'ok' GROUP BY a.cohort, a.year, a.n_units, e.iso_code
""")
cte("p_cohort_factor", ["p_silver", "p_cells"], f"""
SELECT (SELECT count(DISTINCT iso_code) FROM p_silver WHERE {OUTCOME} IS NOT NULL) AS g, sum(n) AS n, count(*) AS k FROM p_cells
""")
_FACTOR_SQL = "(SELECT g / (g - 1.0) * ((n - 1.0) / (n - k)) FROM p_cohort_factor)"


@register("cohort_att", ["p_cohort_att", "p_cohort_influence", "p_cohort_factor"], f"""
SELECT cohort, year, rel_time, round(att, 3) AS att, n_units, status, round(se, 3) AS se,
       round(att - 1.96 * se, 3) AS ci_lower, round(att + 1.96 * se, 3) AS ci_upper
FROM (SELECT a.*, sqrt({_FACTOR_SQL} * v.v) AS se FROM p_cohort_att a
      LEFT JOIN (SELECT cohort, year, sum(psi * psi) AS v FROM p_cohort_influence GROUP BY cohort, year) v
        ON v.cohort = a.cohort AND v.year = a.year) x
""")
def q_cohort_att(spark, sf):
    out = cz.cohort_att(silver(spark, sf), "iso_code", "year", OUTCOME, "ratification_year")
    return out.withColumns({c: F.round(c, 3) for c in ("att", "se", "ci_lower", "ci_upper")})


@register("cohort_att_overall", ["p_cohort_att", "p_cohort_influence", "p_cohort_factor"], f"""
SELECT round(att, 3) AS att, n_cells, n_unit_periods, round(se, 3) AS se,
       round(att - 1.96 * se, 3) AS ci_lower, round(att + 1.96 * se, 3) AS ci_upper
FROM (SELECT sum(att * n_units) / sum(n_units) AS att, count(*) AS n_cells, CAST(sum(n_units) AS BIGINT) AS n_unit_periods,
             (SELECT sqrt({_FACTOR_SQL} * sum(psi * psi))
              FROM (SELECT sum(psi * n_units) / (SELECT sum(n_units) FROM p_cohort_att WHERE year >= cohort AND status = 'ok') AS psi
                    FROM p_cohort_influence WHERE year >= cohort GROUP BY iso_code) u) AS se
      FROM p_cohort_att WHERE year >= cohort AND status = 'ok') x
""")
def q_cohort_att_overall(spark, sf):
    out = cz.cohort_att_overall(silver(spark, sf), "iso_code", "year", OUTCOME, "ratification_year")
    return out.withColumns({c: F.round(c, 3) for c in ("att", "se", "ci_lower", "ci_upper")})


# ---------------------------------------------------------------------------
# Two-way effects with controls, as SQL: unit-demean every column and the
# period dummies, then take them out of all that follow, one by one.
# ---------------------------------------------------------------------------
YEARS = range(1996, 2003)   # first to last order year of the tables, for the dummies


def _orthogonal_sql(name: str, src: str, d: str, controls: list[str], extra: str = "") -> str:
    """att and se of ``d`` on ``y`` with unit and period effects and controls,
    CRV1 by unit (Frisch-Waugh: after the other columns are taken out, one
    regressor is left)."""
    dummies = [f"p{y}" for y in list(YEARS)[1:]]
    steps = [*dummies, *controls, "d", "y"]
    raw = ", ".join([f"CASE WHEN year = {y} THEN 1.0 ELSE 0.0 END AS p{y}" for y in list(YEARS)[1:]]
                    + [f"CAST({c} AS DOUBLE) AS {c}" for c in controls] + [f"CAST({d} AS DOUBLE) AS d", "CAST(y AS DOUBLE) AS y"])
    sql = f"SELECT iso_code, {raw} FROM {src}"
    sql = f"SELECT iso_code, {', '.join(f'{c} - avg({c}) OVER (PARTITION BY iso_code) AS {c}' for c in steps)} FROM ({sql}) r"
    for i, c in enumerate(steps[:-2]):
        # a column with nothing left of it (no such year) takes nothing out
        rest = ", ".join(f"{x} - coalesce(sum({x} * {c}) OVER () / nullif(CASE WHEN sum({c} * {c}) OVER () > 1e-9 "
                         f"THEN sum({c} * {c}) OVER () END, 0), 0) * {c} AS {x}" for x in steps[i + 1:])
        sql = f"SELECT iso_code, {rest} FROM ({sql}) s{i}"
    k = 1 + len(controls)
    return f"""
SELECT '{name}' AS estimator, round(beta, 3) AS att, round(se, 3) AS se,
       round(beta - 1.96 * se, 3) AS ci_lower, round(beta + 1.96 * se, 3) AS ci_upper,
       g AS n_units, n AS n_obs, 'ok' AS status{extra}
FROM (SELECT beta, sqrt(CAST(g AS DOUBLE) / (g - 1) * (n - 1.0) / (n - {k}) * meat) / sdd AS se, g, n
      FROM (SELECT beta, sdd, count(*) AS g, CAST(sum(ng) AS BIGINT) AS n, sum(s * s) AS meat
            FROM (SELECT iso_code, beta, sdd, sum(d * (y - beta * d)) AS s, count(*) AS ng
                  FROM (SELECT *, sum(d * y) OVER () / sum(d * d) OVER () AS beta, sum(d * d) OVER () AS sdd FROM ({sql}) o) b
                  GROUP BY iso_code, beta, sdd) c
            GROUP BY beta, sdd) e) f
"""


_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [OUTCOME, *CONTROLS])
cte("p_controls", ["p_silver"], f"""
SELECT iso_code, year, {OUTCOME} AS y, CASE WHEN {TREATMENT} THEN 1.0 ELSE 0.0 END AS d, {', '.join(CONTROLS)}
FROM p_silver WHERE {_COMPLETE}
""")
cte("p_placebo", ["p_silver"], f"""
SELECT iso_code, year, {OUTCOME} AS y,
       CASE WHEN ratification_year IS NOT NULL AND year >= ratification_year - {PLACEBO_SHIFT} THEN 1.0 ELSE 0.0 END AS d,
       CASE WHEN ratification_year IS NOT NULL AND year >= {FAKE_YEAR} THEN 1.0 ELSE 0.0 END AS fake,
       {', '.join(CONTROLS)}
FROM p_silver WHERE {_COMPLETE} AND (ratification_year IS NULL OR year < ratification_year)
""")
_SIGNIFICANT = ", abs(beta / se) > 1.959963984540054 AS is_significant"


@register("twfe_controls", ["p_controls"], _orthogonal_sql("twfe_controls", "p_controls", "d", CONTROLS))
def q_twfe_controls(spark, sf):
    return _est(cz.twfe(silver(spark, sf), OUTCOME, TREATMENT, CONTROLS, "iso_code", "year",
                        estimator="twfe_controls", fallback=True))


def _placebo(df):
    return _est(df).join(df.select("estimator", "is_significant"), "estimator")


@register("placebo", ["p_placebo"], _orthogonal_sql("placebo", "p_placebo", "d", CONTROLS, _SIGNIFICANT))
def q_placebo(spark, sf):
    return _placebo(cz.placebo(silver(spark, sf), OUTCOME, "iso_code", "year", "ratification_year", PLACEBO_SHIFT, CONTROLS))


@register("placebo_fake_year", ["p_placebo"], _orthogonal_sql("placebo", "p_placebo", "fake", [], _SIGNIFICANT))
def q_placebo_fake_year(spark, sf):
    complete = silver(spark, sf).dropna(subset=CONTROLS)
    return _placebo(cz.placebo(complete, OUTCOME, "iso_code", "year", "ratification_year", fake_year=FAKE_YEAR))


# ---------------------------------------------------------------------------
# Double ML
# ---------------------------------------------------------------------------
# Double ML as SQL: moments of each training set, lassos by coordinate descent
# in a recursion (a sweep a step), penalties by the error on held-out units,
# residuals, and the final stage with the interactions taken out one by one.
_XS = [f"x{i}" for i in range(1, len(CONTROLS) + 1)]
_PAIRS = [(a, b) for i, a in enumerate(_XS) for b in _XS[i + 1:]]
_HASH_SQL = "CAST('0x' || substr(md5(iso_code || ':{}'), 1, 8) AS BIGINT)"


def _gram(a: str, b: str) -> str:
    return f"g_{min(a, b)}{max(a, b)}"


def _sweep_sql() -> str:
    """One sweep: each coefficient from the new ones before it and the old
    ones after it."""
    sql, names = "SELECT *, i + 1 AS j FROM lassos WHERE moved > 1e-15 * size AND i < 100000", []
    for x in _XS:
        rest = " ".join(f"- {_gram(x, o)} * {'n_' if o in names else 'b_'}{o}" for o in _XS if o != x)
        sql = f"SELECT *, c_{x} {rest} AS r_{x} FROM ({sql}) s"
        sql = f"SELECT *, sign(r_{x}) * greatest(abs(r_{x}) - penalty, 0) AS n_{x} FROM ({sql}) s"
        names.append(x)
    keep = ", ".join([*[_gram(a, b) for a, b in _PAIRS], *[f"c_{x}" for x in _XS]])
    moved = ", ".join(f"abs(n_{x} - b_{x})" for x in _XS)
    return f"SELECT k, part, target, penalty, size, {keep}, {', '.join(f'n_{x}' for x in _XS)}, greatest({moved}), CAST(j AS INTEGER) FROM ({sql}) s"


def _final_sql() -> str:
    """``ate`` and its robust error: the interactions taken out of the
    d-residual and the y-residual."""
    steps = [f"z_{x}" for x in _XS] + ["rd", "ry"]
    sql = f"SELECT ry, rd, {', '.join(f'rd * ({x} - avg({x}) OVER ()) AS z_{x}' for x in _XS)} FROM p_dml_residuals"
    for i, z in enumerate(steps[:-2]):
        rest = ", ".join(f"{o} - sum({o} * {z}) OVER () / sum({z} * {z}) OVER () * {z} AS {o}" for o in steps[i + 1:])
        sql = f"SELECT {rest} FROM ({sql}) s{i}"
    return sql


cte("p_dml", ["p_silver"], f"""
SELECT iso_code, {', '.join(f'CAST({c} AS DOUBLE) AS {x}' for c, x in zip(CONTROLS, _XS))},
       CAST({OUTCOME} AS DOUBLE) AS y, CAST(CAST({TREATMENT} AS INTEGER) AS DOUBLE) AS d,
       {_HASH_SQL.format(42)} % 2 AS fold, {_HASH_SQL.format(43)} % 4 = 0 AS held
FROM p_silver WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [*CONTROLS, OUTCOME, TREATMENT, 'iso_code'])}
""")
cte("p_dml_sets", ["p_dml"], f"""
SELECT k, part, target, {', '.join(_XS)}, CASE target WHEN 'y' THEN y ELSE d END AS t
FROM p_dml, (VALUES (0), (1)) f(k), (VALUES ('inner'), ('held'), ('train')) s(part), (VALUES ('y'), ('d')) g(target)
WHERE fold <> k AND (part = 'train' OR (part = 'held') = held)
""")
cte("p_dml_moments", ["p_dml_sets"], f"""
SELECT k, part, target, avg(t) AS m_t, {', '.join(f'avg({x}) AS m_{x}, stddev_pop({x}) AS s_{x}, covar_pop({x}, t) / stddev_pop({x}) AS c_{x}' for x in _XS)},
       {', '.join(f'covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b})) AS {_gram(a, b)}' for a, b in _PAIRS)}
FROM p_dml_sets WHERE part <> 'held' GROUP BY k, part, target
""")
cte("p_dml_lassos", ["p_dml_moments"], f"""
WITH RECURSIVE lassos AS (
  SELECT k, part, target, penalty, greatest({', '.join(f'abs(c_{x})' for x in _XS)}) AS size,
         {', '.join([*[_gram(a, b) for a, b in _PAIRS], *[f'c_{x}' for x in _XS]])}, {', '.join(f'CAST(0 AS DOUBLE) AS b_{x}' for x in _XS)},
         CAST(1e300 AS DOUBLE) AS moved, 0 AS i
  FROM p_dml_moments, (VALUES {', '.join(f'(CAST({p!r} AS DOUBLE))' for p in cz.PENALTIES)}) p(penalty)
  UNION ALL {_sweep_sql()})
SELECT l.k, l.part, l.target, l.penalty, {', '.join(f'b_{x} / s_{x} AS k_{x}' for x in _XS)}, m_t - {' - '.join(f'b_{x} / s_{x} * m_{x}' for x in _XS)} AS k_0
FROM (SELECT k, part, target, penalty, {', '.join(f'arg_max(b_{x}, i) AS b_{x}' for x in _XS)} FROM lassos GROUP BY ALL) l
JOIN p_dml_moments m ON m.k = l.k AND m.part = l.part AND m.target = l.target
""")
cte("p_dml_chosen", ["p_dml_sets", "p_dml_lassos"], f"""
SELECT l.* FROM p_dml_lassos l JOIN (
  SELECT k, target, arg_min(penalty, (e, penalty)) AS penalty
  FROM (SELECT h.k, h.target, f.penalty, avg(pow(t - k_0 - {' - '.join(f'k_{x} * {x}' for x in _XS)}, 2)) AS e
        FROM p_dml_sets h JOIN p_dml_lassos f ON f.k = h.k AND f.target = h.target AND f.part = 'inner' WHERE h.part = 'held'
        GROUP BY h.k, h.target, f.penalty) x
  GROUP BY k, target) c ON c.k = l.k AND c.target = l.target AND c.penalty = l.penalty
WHERE l.part = 'train'
""")
cte("p_dml_residuals", ["p_dml", "p_dml_chosen"], f"""
SELECT {', '.join(_XS)}, y - a.k_0 - {' - '.join(f'a.k_{x} * {x}' for x in _XS)} AS ry, d - b.k_0 - {' - '.join(f'b.k_{x} * {x}' for x in _XS)} AS rd
FROM p_dml JOIN p_dml_chosen a ON a.k = fold AND a.target = 'y' JOIN p_dml_chosen b ON b.k = fold AND b.target = 'd'
""")


@register("double_ml", ["p_dml_residuals"], f"""
SELECT round(ate, 2) AS ate, round(ate - 1.96 * se, 2) AS ci_lower, round(ate + 1.96 * se, 2) AS ci_upper, n AS n_obs, 'ok' AS status
FROM (SELECT any_value(ate) AS ate, sqrt(sum(rd * rd * pow(ry - ate * rd, 2))) / sum(rd * rd) AS se, count(*) AS n
      FROM (SELECT rd, ry, sum(rd * ry) OVER () / sum(rd * rd) OVER () AS ate FROM ({_final_sql()}) f) g) h
""")
def q_double_ml(spark, sf):
    out = cz.double_ml(silver(spark, sf), OUTCOME, TREATMENT, CONTROLS, "iso_code")
    return out.withColumns({c: F.round(c, 2) for c in ("ate", "ci_lower", "ci_upper")})


# ---------------------------------------------------------------------------
# Rows-only (no SQL twin; covered by brute-force tests)
# ---------------------------------------------------------------------------
def recon_errors(spark, sf):
    """Standardised features (statistics of the rows before the cut-off) ->
    windows -> reconstruction error at each window's last day."""
    z = zscored(spark, sf).select("user_id", "day", *[f"z_{c}" for c in FEATS])
    seqs = win.sequences(z, "user_id", "day", [f"z_{c}" for c in FEATS], W, step="day")
    return an.pca_recon_error(seqs, "user_id", "start", "seq", d=W * len(FEATS), k=2,
                              fit_before=F.lit(CUTOFF_DAY).cast("date"), step="day")


@register("pca_recon_error")
def q_pca_recon_error(spark, sf):
    return recon_errors(spark, sf)


@register("anomaly_chain")
def q_anomaly_chain(spark, sf):
    """M4 -> M5 -> M6 -> M8: the reconstruction errors flagged per user, with
    the known-event label of the day's year."""
    scores = recon_errors(spark, sf).withColumn("year", F.year("day"))
    flagged = an.label_events(an.flag_top(scores, "user_id", "recon_error", 0.05))
    total = F.count_if(F.col("is_anomaly")).over(Window.partitionBy("user_id"))
    return flagged.select("user_id", "day", "is_anomaly", "recon_error", "event_label", total.alias("total_anomalies"))


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    return an.isolation_forest(ffilled(spark, sf), "user_id", "day", FEATS)
