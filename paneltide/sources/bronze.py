"""Sources and sinks (S-operators): landing files with provenance, snapshot
partitions, format dispatch, and layer materialisation."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.operators.joins import broadcast_if_small
from paneltide.sources import commits
from paneltide.sources.commits import PARTITION_COL



def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Pass a schema in production: inference costs an
    extra pass over the files and can change types between snapshots."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def iso_utc(ts: Column | None = None) -> Column:
    """ISO-8601 UTC text of a timestamp (default: now), in any session zone,
    e.g. 2024-05-01T10:00:00.000000+00:00."""
    return F.date_format(_utc_clock(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _utc_clock(ts: Column | None = None) -> Column:
    """The timestamp whose local reading is the UTC reading of ``ts``."""
    return F.to_utc_timestamp(F.current_timestamp() if ts is None else ts, F.current_timezone())


def utc_day(ts: Column | None = None) -> Column:
    """The UTC date of a timestamp (default: now)."""
    return F.to_date(_utc_clock(ts))


def stamp(df: DataFrame, source_url: str, ingested_at: str | None = None) -> DataFrame:
    """Provenance columns. ``ingested_at`` is injectable for tests and
    replays; by default the load time is used."""
    at = F.lit(ingested_at) if ingested_at is not None else iso_utc()
    return df.withColumn("_ingested_at", at).withColumn("_source_url", F.lit(source_url))


def append_bronze(df: DataFrame, path: str, day: str | None = None) -> None:
    """S3: write one day's snapshot (UTC day of the load by default) under
    ``ingestion_date=YYYY-MM-DD`` and commit it.

    A same-day rerun replaces that day, also when it has no rows, and leaves
    other days alone; until the commit readers see the day as it was."""
    when = dt.date.fromisoformat(day) if day is not None else dt.datetime.now(dt.timezone.utc).date()
    commits.append(df, path, when)


def literal_dimension(spark: SparkSession, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table (always safe to broadcast)."""
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------
# Treaty ratification years by ISO code (the reference's
# literal dimension, 40 rows), and the indicator code -> column names.
# ---------------------------------------------------------------------------
RATIFICATION_ROWS = [
    ("USA", "United States", 2016), ("CHN", "China", 2016), ("IND", "India", 2016),
    ("RUS", "Russia", 2019), ("JPN", "Japan", 2016), ("DEU", "Germany", 2016),
    ("KOR", "South Korea", 2016), ("CAN", "Canada", 2016), ("GBR", "United Kingdom", 2016),
    ("FRA", "France", 2016), ("ITA", "Italy", 2016), ("AUS", "Australia", 2016),
    ("BRA", "Brazil", 2016), ("ZAF", "South Africa", 2016), ("MEX", "Mexico", 2016),
    ("IDN", "Indonesia", 2016), ("SAU", "Saudi Arabia", 2016), ("TUR", "Turkey", 2016),
    ("ARG", "Argentina", 2016), ("POL", "Poland", 2016), ("NLD", "Netherlands", 2016),
    ("BEL", "Belgium", 2016), ("ESP", "Spain", 2016), ("SWE", "Sweden", 2016),
    ("NOR", "Norway", 2016), ("CHE", "Switzerland", 2016), ("NZL", "New Zealand", 2016),
    ("PRT", "Portugal", 2016), ("GRC", "Greece", 2016), ("CZE", "Czechia", 2017),
    ("HUN", "Hungary", 2016), ("ROU", "Romania", 2016), ("BGD", "Bangladesh", 2016),
    ("PAK", "Pakistan", 2016), ("NGA", "Nigeria", 2016), ("ETH", "Ethiopia", 2016),
    ("EGY", "Egypt", 2017), ("IRN", "Iran", 2017), ("IRQ", "Iraq", 2021),
    ("DZA", "Algeria", 2016),
]
INDICATOR_CODES = {
    "NY.GDP.MKTP.KD.ZG": "gdp_growth_pct",
    "SP.URB.TOTL.IN.ZS": "urban_population_pct",
    "NV.IND.MANF.ZS": "manufacturing_pct_gdp",
}


def ratifications(spark: SparkSession, ingested_at: str | None = None,
                  source_url: str = "treaty-collection") -> DataFrame:
    """The ratification dimension with provenance."""
    df = literal_dimension(spark, RATIFICATION_ROWS,
                           "iso_code string, country string, ratification_year int")
    return stamp(df, source_url, ingested_at)


def normalise_indicators(raw: DataFrame, lookup: DataFrame, name_col: str = "country",
                         year_col: str = "date", lookup_name: str = "name",
                         lookup_code: str = "id", renames: dict[str, str] | None = None) -> DataFrame:
    """Rename indicator columns, coerce the year text to a number
    ("2001" and "2001.0" are 2001; other text is dropped; ANSI ``cast`` would
    raise), attach the code through a name lookup and drop names without a
    code (inner join). A name that the lookup has twice counts once."""
    df = raw
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    number = F.col(year_col).cast("string").try_cast("double")
    df = (df.withColumnRenamed(name_col, "country_name")
            .withColumn("year", F.when(number == F.floor(number), number).try_cast("int"))
            .where(F.col("year").isNotNull()))
    if year_col != "year":
        df = df.drop(year_col)
    lk = broadcast_if_small(lookup.groupBy(F.col(lookup_name).alias("_lk_name"))
                                  .agg(F.max(lookup_code).alias("iso_code")))
    return df.join(lk, df["country_name"] == lk["_lk_name"], "inner").drop("_lk_name")


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A snapshot directory; partition discovery adds ``ingestion_date``.
    Of a directory with a commit log only committed loads are read."""
    committed = commits.read(spark, path, schema)
    if committed is not None:
        return committed
    r = spark.read
    if schema is not None:
        r = r.schema(T.StructType(list(schema.fields) + [T.StructField(PARTITION_COL, T.DateType())]))
    return r.parquet(path)


def read_latest(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S6 + S7: the newest day of a snapshot directory that has rows. The day
    is read off the commit log, or else off the file listing, so only that
    day's files are scanned."""
    committed = commits.read(spark, path, schema, newest=True)
    if committed is not None:
        return committed
    df = read_bronze(spark, path, schema)
    days = commits.listed_days(df)
    return df.where(F.col(PARTITION_COL) == F.lit(days[-1]).cast("date")) if days else df


def latest_snapshot(df: DataFrame, col: str = PARTITION_COL) -> DataFrame:
    """Rows of the newest snapshot of any DataFrame; the maximum is a
    scalar subquery over its rows. For files ``read_latest`` needs no scan to
    find the day."""
    newest = df.select(F.max(col)).scalar()
    return df.where(F.col(col) == newest)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a layer."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A directory or .parquet path -> parquet; .csv -> CSV with header."""
    p = path.rstrip("/")
    kind = os.path.splitext(p)[1]
    if kind == ".csv":
        return read_csv(spark, p, schema)
    if kind not in ("", ".parquet") and "=" not in kind:
        raise ValueError(f"unsupported input: {path}")
    # Spark resolves the path, whatever store it is in
    found = spark.read.parquet(p)
    if schema is None:
        return found
    part = [f for f in found.schema.fields if f.name == PARTITION_COL and f.name not in schema.names]
    return spark.read.schema(T.StructType([*schema.fields, *part])).parquet(p)


def materialise(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """S10: 'view' -> temp view; 'ephemeral' -> the DataFrame itself (inlined
    by Catalyst where used); 'table' -> written parquet read back, which also
    cuts the lineage."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "ephemeral":
        return df
    if kind == "table":
        if path is None:
            raise ValueError("a table needs a path in shared storage")
        df.write.mode("overwrite").parquet(path)
        out = spark.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(kind)


def register_source(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A named view over an external location, for SQL models."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df
