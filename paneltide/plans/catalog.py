"""Query catalogue: every registered query as a Spark plan plus the same
query written in SQL for the DuckDB oracle.

Spark side: ``QUERIES[name](spark, sf_dir) -> DataFrame`` built from the
library operators. SQL side: ``oracle_sql()[name]``, assembled from shared
CTEs (the proxy panels and layers) and a final SELECT. Both sides alias every
computed column identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_FINAL_SQL: dict[str, tuple[list[str], str]] = {}
CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (deps, sql)


def register(name: str, ctes: list[str] | None = None, sql: str | None = None):
    """Register a Spark query; ``sql`` (with the CTEs it reads) is its oracle.
    Queries without SQL get the driver's rows-only check and brute-force tests."""

    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            _FINAL_SQL[name] = (ctes or [], sql)
        return fn

    return deco


def _resolve(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def build_sql(name: str) -> str:
    deps, final = _FINAL_SQL[name]
    order = _resolve(deps)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
    return f"WITH {body}\n{final.strip()}"


def oracle_sql() -> dict[str, str]:
    from paneltide.plans import registry  # noqa: F401  (registers everything)

    return {n: build_sql(n) for n in _FINAL_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from paneltide.plans import registry  # noqa: F401

    return dict(QUERIES)
