"""Streaming landing: each landed file is appended exactly once."""

import os

from paneltide.streaming.landing import land
from paneltide.sources.bronze import read_bronze

SCHEMA = "iso_code string, year int, co2 double"


def _write(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("iso_code,year,co2\n" + "\n".join(lines) + "\n")


def test_landing_is_incremental_and_exactly_once(spark, tmp_dir):
    from pyspark.sql import types as T

    schema = T._parse_datatype_string(SCHEMA)
    src, bronze = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "bronze")
    os.makedirs(src)
    _write(src, "a.csv", ["USA,2000,1.5", "CHN,2000,2.5"])
    land(spark, src, schema, bronze, "landing://test", "t1")
    assert read_bronze(spark, bronze).count() == 2
    land(spark, src, schema, bronze, "landing://test", "t1")          # rerun: nothing new
    assert read_bronze(spark, bronze).count() == 2
    _write(src, "b.csv", ["IND,2001,3.0"])
    land(spark, src, schema, bronze, "landing://test", "t1")
    df = read_bronze(spark, bronze)
    assert df.count() == 3
    assert set(df.columns) >= {"_ingested_at", "_source_url", "ingestion_date"}
