"""Data-quality checks (Q-operators).

A suite folds all of its column checks into ONE aggregation pass (partial
aggregates in every task), turns the wide result into one row per check with
``stack``, and adds one grouped count for each uniqueness check. Schema-level
checks (column exists, column count, type) need no job at all.

Result rows: suite, check_name, column_name, severity, passed, observed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.sources.contracts import Contract

RESULT_SCHEMA = T.StructType([
    T.StructField("suite", T.StringType()), T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("passed", T.BooleanType()), T.StructField("observed", T.LongType()),
])


@dataclass
class Check:
    """One expectation. ``kind`` is one of: exists, column_count, type,
    not_null, between, row_count, distinct_at_least, accepted, unique,
    custom (a failing-rows predicate)."""

    kind: str
    column: str | None = None
    params: dict = field(default_factory=dict)
    severity: str = "error"
    where: str | None = None

    @property
    def label(self) -> str:
        return self.params.get("label", self.kind)


def exists(c, **kw): return Check("exists", c, **kw)  # noqa: E704
def column_count(n, **kw): return Check("column_count", None, {"n": n}, **kw)  # noqa: E704
def not_null(c, **kw): return Check("not_null", c, **kw)  # noqa: E704
def between(c, lo=None, hi=None, **kw): return Check("between", c, {"lo": lo, "hi": hi}, **kw)  # noqa: E704
def row_count(lo=None, hi=None, **kw): return Check("row_count", None, {"lo": lo, "hi": hi}, **kw)  # noqa: E704
def distinct_at_least(c, n, **kw): return Check("distinct_at_least", c, {"n": n}, **kw)  # noqa: E704
def accepted(c, values, **kw): return Check("accepted", c, {"values": values}, **kw)  # noqa: E704
def unique(cols, **kw): return Check("unique", ",".join(cols), {"cols": cols}, **kw)  # noqa: E704
def has_type(c, t, **kw): return Check("type", c, {"type": t}, **kw)  # noqa: E704


def share_at_least(label: str, predicate: str, share: float, **kw) -> Check:
    """Q9: at least ``share`` of the rows satisfy ``predicate`` (an empty
    table fails). Observed value is the share in basis points."""
    return Check("share_at_least", None, {"label": label, "predicate": predicate, "share": share}, **kw)


def custom(label: str, failing: str, **kw) -> Check:
    """A failing-rows test: passes when no row satisfies ``failing`` (a SQL
    predicate over the table)."""
    return Check("custom", None, {"label": label, "failing": failing}, **kw)


def _lit(s: str | None) -> str:
    return "CAST(NULL AS STRING)" if s is None else "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _observed(ch: Check, df: DataFrame) -> Column | None:
    """Aggregate that yields the observed number for a check; None if a column
    that it names is missing."""
    o = _aggregate(ch, df)
    if o is None:
        return None
    try:
        df.agg(o.alias("o")).schema
    except AnalysisException as e:
        if "UNRESOLVED_COLUMN" in str(e):
            return None
        raise
    return o


def _aggregate(ch: Check, df: DataFrame) -> Column | None:
    cols = set(df.columns)
    if ch.column is not None and ch.kind not in ("unique",) and ch.column not in cols:
        return None
    cond = F.expr(ch.where) if ch.where else F.lit(True)
    if ch.kind == "not_null":
        return F.count_if(cond & F.col(ch.column).isNull())
    if ch.kind == "between":
        c, lo, hi = F.col(ch.column), ch.params["lo"], ch.params["hi"]
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (c < lo)
        if hi is not None:
            bad = bad | (c > hi)
        return F.count_if(cond & c.isNotNull() & bad)
    if ch.kind == "row_count":
        return F.count(F.lit(1))
    if ch.kind == "distinct_at_least":
        return F.count_distinct(ch.column)
    if ch.kind == "accepted":
        c = F.col(ch.column)
        return F.count_if(cond & c.isNotNull() & ~c.isin(ch.params["values"]))
    if ch.kind == "custom":
        return F.count_if(F.expr(ch.params["failing"]))
    if ch.kind == "share_at_least":
        # share of rows meeting the predicate, in basis points (floor)
        hits = F.count_if(F.expr(ch.params["predicate"])).cast("double")
        return F.floor(F.try_divide(F.lit(10000.0) * hits, F.count(F.lit(1))))
    raise ValueError(ch.kind)


def _passed(ch: Check, obs: Column) -> Column:
    if ch.kind in ("not_null", "between", "accepted", "custom", "unique"):
        return obs == 0
    if ch.kind == "row_count":
        ok = F.lit(True)
        if ch.params["lo"] is not None:
            ok = ok & (obs >= ch.params["lo"])
        if ch.params["hi"] is not None:
            ok = ok & (obs <= ch.params["hi"])
        return ok
    if ch.kind == "distinct_at_least":
        return obs >= ch.params["n"]
    if ch.kind == "share_at_least":
        return F.coalesce(obs >= round(ch.params["share"] * 10000), F.lit(False))
    raise ValueError(ch.kind)


def run_suite(df: DataFrame, suite: str, checks: list[Check]) -> DataFrame:
    """Q11: evaluate a suite; one row per check."""
    spark = df.sparkSession
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    static_rows, agg_checks, uniq_checks = [], [], []
    for ch in checks:
        if ch.kind == "exists":
            ok = ch.column in types
            static_rows.append((suite, ch.label, ch.column, ch.severity, ok, int(ok)))
        elif ch.kind == "column_count":
            n = len(df.columns)
            static_rows.append((suite, ch.label, None, ch.severity, n == ch.params["n"], n))
        elif ch.kind == "type":
            ok = types.get(ch.column) == ch.params["type"]
            static_rows.append((suite, ch.label, ch.column, ch.severity, ok, int(ok)))
        elif ch.kind == "unique":
            uniq_checks.append(ch)
        else:
            agg_checks.append(ch)

    parts: list[DataFrame] = []
    if static_rows:
        parts.append(spark.createDataFrame(static_rows, RESULT_SCHEMA))
    exprs, meta = [], []
    for ch in agg_checks:
        o = _observed(ch, df)
        if o is None:  # the column is missing: the check fails, nothing to compute
            parts.append(spark.createDataFrame([(suite, ch.label, ch.column, ch.severity, False, None)],
                                               RESULT_SCHEMA))
            continue
        exprs.append(o.cast("bigint").alias(f"_o{len(meta)}"))
        meta.append(ch)
    if exprs:
        wide = df.agg(*exprs)
        rows = []
        for i, ch in enumerate(meta):
            rows.append(f"{_lit(ch.label)}, {_lit(ch.column)}, {_lit(ch.severity)}, `_o{i}`, {i}")
        long = wide.select(F.expr(
            f"stack({len(meta)}, {', '.join(rows)}) AS (check_name, column_name, severity, observed, idx)"))
        passed = F.lit(None).cast("boolean")
        for i, ch in enumerate(meta):
            passed = F.when(F.col("idx") == i, _passed(ch, F.col("observed"))).otherwise(passed)
        parts.append(long.select(F.lit(suite).alias("suite"), "check_name", "column_name", "severity",
                                 passed.alias("passed"), "observed"))
    for ch in uniq_checks:
        cols = ch.params["cols"]
        missing = [c for c in cols if c not in types]
        if missing:
            parts.append(spark.createDataFrame([(suite, ch.label, ch.column, ch.severity, False, None)],
                                               RESULT_SCHEMA))
            continue
        # groups that occur more than once; the grouped count is partial on
        # the map side, so heavy duplicate keys are folded before the shuffle
        dups = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
                .agg(F.count(F.lit(1)).cast("bigint").alias("observed")))
        parts.append(dups.select(F.lit(suite).alias("suite"), F.lit(ch.label).alias("check_name"),
                                 F.lit(ch.column).alias("column_name"), F.lit(ch.severity).alias("severity"),
                                 (F.col("observed") == 0).alias("passed"), "observed"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contract_checks(c: Contract) -> list[Check]:
    """Q13: a layer contract as checks: every column present with its type,
    column count, non-NULL columns, ranges, size, key count, primary key,
    accepted values."""
    checks: list[Check] = []
    for f in c.schema.fields:
        checks.append(exists(f.name))
        checks.append(has_type(f.name, f.dataType.simpleString()))
    checks.append(column_count(len(c.schema.fields)))
    checks += [not_null(x) for x in c.not_null]
    checks += [between(k, lo, hi) for k, (lo, hi) in c.ranges.items()]
    if c.min_rows is not None or c.max_rows is not None:
        checks.append(row_count(c.min_rows, c.max_rows))
    if c.min_keys is not None and c.key:
        checks.append(distinct_at_least(c.key, c.min_keys, severity="warn"))
    if c.primary_key:
        checks.append(unique(c.primary_key))
    checks += [accepted(k, v) for k, v in c.accepted.items()]
    return checks


class QualityGateError(RuntimeError):
    pass


def gate(results: DataFrame) -> None:
    """Q12: raise when an error-severity check failed. The failing results are
    collected: a row per check of the suite."""
    bad = results.where((F.col("severity") == "error") & ~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if bad:
        lines = [f"{r['suite']}.{r['check_name']}({r['column_name']}): observed={r['observed']}" for r in bad]
        raise QualityGateError("quality gate failed:\n" + "\n".join(lines))
