"""Driver contract: entry() runs, every registered query runs on the smallest
tables, and each query with a SQL twin returns the same rows as DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from paneltide.plans import catalog
from tests.conftest import SF_SMALL
from tools.compare import TABLES, rows_of

QUERIES = catalog.queries()
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["year", "iso_code", "country_name"]


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    spdf = sdf.toPandas()
    if name not in SQL:
        assert len(spdf) >= 1
        return
    dpdf = duck.execute(SQL[name]).df()
    sc, sr = rows_of(spdf)
    dc, dr = rows_of(dpdf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
