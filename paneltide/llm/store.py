"""Intermediate tables in the shared folder, and small DataFrame helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Only Spark opens the path, so any store it knows works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so an executor lost later costs no recomputation of what came before."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, by Spark's own file server, as
    ``--py-files`` would. Once per context."""
    sc = spark.sparkContext
    if getattr(sc, "_paneltide_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(top):
        path = os.path.join(tempfile.mkdtemp(prefix="paneltide-ship-"), "paneltide.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
    sc._paneltide_shipped = True


def bound_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Let the session send about ``most`` bytes to Python at a time (Spark's
    64 MB otherwise; a smaller limit stays). Memory for a batch is taken in the
    JVM and in each Python worker, which both keep it for the steps to come."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now <= 0 or now > most:
        spark.conf.set(key, f"{most}b")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose tables are written: it
    does so once the driver's plans of them are collected as garbage. Python's
    gateway lets go of freed plans in a thread of its own, from a queue, so
    that is waited for (ten seconds at most), and what hangs on them goes in a
    second collection."""
    gc.collect()
    queue = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())
    for _ in range(100):
        time.sleep(0.1)
        if not queue:
            break
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder once nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def partition_offsets(totals: DataFrame, part: str, total: str, out: str) -> DataFrame:
    """(part, sum of the totals of all smaller parts). ``totals`` has one row
    per partition of a job, so the unpartitioned window sees no data rows."""
    w = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(w), F.lit(0)).cast("long").alias(out))
