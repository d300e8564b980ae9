"""S3: a day-partitioned snapshot folder with a commit log.

A run writes its rows into a folder of its own,
``ingestion_date=D/load=<id>/``, and then one line to ``_commits/``: the day,
the load, its rows and a number above all earlier ones. Readers take, for each
day, the load of its last commit and nothing else. So a rerun replaces its day
in one step, a rerun without rows empties it, a run that dies half-way changes
nothing, and readers of the older load aren't disturbed. The log has one small
line for each run; what reaches the driver is one row for each day.

A folder that was written without a log is adopted by its first commit: the
days it has are logged as they lie.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COL = "ingestion_date"
LOAD = "load"
LOG = "_commits"
# load is null for days that were there before the log
ENTRY = "day date, load string, n_rows long, number long"


def log(spark: SparkSession, path: str) -> DataFrame | None:
    """All commits, or None for a folder without a log."""
    try:
        return spark.read.schema(ENTRY).json(f"{path}/{LOG}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def current(spark: SparkSession, path: str) -> list | None:
    """The valid commit of each day, oldest day first."""
    entries = log(spark, path)
    if entries is None:
        return None
    last = entries.groupBy("day").agg(F.max(F.struct("number", "load", "n_rows")).alias("c"))
    return last.select("day", "c.*").orderBy("day").collect()


def _write(spark: SparkSession, path: str, entries: list[tuple]) -> None:
    spark.createDataFrame(entries, ENTRY).coalesce(1).write.mode("append").json(f"{path}/{LOG}")


def listed_days(df: DataFrame, col: str = PARTITION_COL) -> list[str]:
    """The values of a partition column in the paths of a frame's files."""
    return sorted({m[1] for f in df.inputFiles() if (m := re.search(rf"/{col}=([^/]+)/", f))})


def _adopt(spark: SparkSession, path: str) -> None:
    try:
        days = listed_days(spark.read.option("basePath", path).parquet(f"{path}/{PARTITION_COL}=*/*.parquet"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    _write(spark, path, [(dt.date.fromisoformat(d), None, None, 0) for d in days])


def append(df: DataFrame, path: str, day: dt.date) -> None:
    """Write ``df`` as the day's rows and commit them."""
    spark, path = df.sparkSession, path.rstrip("/")
    if log(spark, path) is None:
        _adopt(spark, path)
    load, seen = uuid.uuid4().hex, Observation()
    # counted as they are written
    rows = df.drop(PARTITION_COL, LOAD)  # both come from the folder
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/{PARTITION_COL}={day}/{LOAD}={load}")
    entries = log(spark, path)
    number = (entries.agg(F.max("number")).first()[0] or 0) + 1 if entries is not None else 1
    _write(spark, path, [(day, load, seen.get["n"], number)])


def _folder(path: str, entry) -> str:
    day = f"{path}/{PARTITION_COL}={entry['day']}"
    return f"{day}/*.parquet" if entry["load"] is None else f"{day}/{LOAD}={entry['load']}"


def read(spark: SparkSession, path: str, schema: T.StructType | None = None, newest: bool = False) -> DataFrame | None:
    """The committed rows with their day, or those of the newest day that has
    any; None for a folder without a log. Only the folders of valid loads are
    listed and scanned."""
    path = path.rstrip("/")
    entries = current(spark, path)
    if entries is None:
        return None
    full = [e for e in entries if e["n_rows"] != 0]
    taken = (full[-1:] if newest else full) or entries[-1:]  # an empty load still has its schema
    reader = spark.read.option("basePath", path)
    if schema is not None:
        extra = [T.StructField(PARTITION_COL, T.DateType()), T.StructField(LOAD, T.StringType())]
        reader = reader.schema(T.StructType([*schema.fields, *extra]))
    own, adopted = [e for e in taken if e["load"] is not None], [e for e in taken if e["load"] is None]
    parts = [reader.parquet(*[_folder(path, e) for e in some]) for some in (own, adopted) if some]
    frames = [p.drop(LOAD) for p in parts]
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], allowMissingColumns=True)
