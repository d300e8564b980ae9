"""Incremental landing of source snapshots with Structured Streaming.

The batch form (sources.bronze.append_bronze) lands one day's file per run.
Here new files arriving in a landing folder are picked up as a file stream,
stamped with provenance, and appended to the Bronze table partitioned by
``ingestion_date``. The stream's checkpoint records which files were taken,
so a rerun (or a restart after a lost executor or driver) lands every file
exactly once. ``trigger(availableNow=True)`` processes what is there and
stops, which is how a scheduled daily job uses it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.sources.bronze import PARTITION_COL, iso_utc, utc_day
from paneltide.session import checkpoint_dir


def read_landing(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "csv",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over the landing folder (explicit schema: no inference)."""
    r = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        r = r.option("header", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def stamp_stream(df: DataFrame, source_url: str) -> DataFrame:
    """Provenance for streamed rows: load time (UTC, ISO text), source, and
    the partition day derived from the load time."""
    now = F.current_timestamp()
    return (df.withColumn("_ingested_at", iso_utc(now))
              .withColumn("_source_url", F.lit(source_url))
              .withColumn(PARTITION_COL, utc_day(now)))


def land(spark: SparkSession, folder: str, schema: T.StructType, bronze_path: str, source_url: str,
         name: str, fmt: str = "csv", available_now: bool = True):
    """Start (and, with ``available_now``, finish) the landing stream.

    The stream checkpoint lives under the session's shared checkpoint folder
    (``spark.checkpoint.dir``), never on a machine-local path.
    """
    ckpt = os.path.join(checkpoint_dir(spark), "streams", name)
    q = (stamp_stream(read_landing(spark, folder, schema, fmt), source_url)
         .writeStream.format("parquet")
         .option("path", bronze_path)
         .option("checkpointLocation", ckpt)
         .partitionBy(PARTITION_COL)
         .outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle
