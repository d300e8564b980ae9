"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Shuffle partitions are a starting point only:
# AQE coalesces small partitions and splits skewed ones at runtime. Scan
# splits of 256 MiB keep the task count of a 100 TB scan in the hundreds of
# thousands rather than near a million.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# On a cluster, coalesce towards the advisory size rather than towards maximal
# parallelism (which leaves thousands of tiny tasks on a busy cluster). Local
# runs keep the default so a small shuffle still spreads over all cores.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}

SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(shuffle_bytes: int, partition_bytes: int = SHUFFLE_PARTITION_BYTES,
                           minimum: int = 200, maximum: int = 100_000) -> int:
    """Initial shuffle partition count for a job whose largest shuffle moves
    about ``shuffle_bytes``: partitions of about ``partition_bytes`` fit in an
    executor task's memory without much spilling. AQE coalesces the partitions
    of smaller shuffles, so erring high costs little. Capped at ``maximum``:
    the driver tracks map outputs per (map task x reducer), and beyond ~10^5
    reducers that bookkeeping, not the data, becomes the bottleneck; larger
    partitions spill instead. The operators here pre-aggregate on the map
    side, so their shuffles are usually a small fraction of the input."""
    return min(maximum, max(minimum, -(-int(shuffle_bytes) // partition_bytes)))


def build_session(
    master: str | None = None,
    app_name: str = "paneltide",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    shuffle_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster, leave ``master`` as None so spark-submit decides, and pass
    ``shuffle_bytes`` (the largest shuffle expected, e.g. the fact columns a
    job reads) to size the shuffle: 10 TB gives 40,960 initial partitions of
    256 MiB, which AQE coalesces per stage. ``shuffle_partitions`` overrides
    it (tests).
    """
    if shuffle_partitions is None and shuffle_bytes is not None:
        shuffle_partitions = shuffle_partitions_for(shuffle_bytes)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if not (master or "").startswith("local"):
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    A cluster must set it to storage every executor can reach; if it is unset
    there, this raises rather than checkpoint to a machine-local folder. Only
    a local-mode session (tests) with the setting unset gets a fresh
    temporary folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: set it to shared storage every executor "
                "can reach (the iterative and multi-pass operators cut lineage there)")
        current = tempfile.mkdtemp(prefix="paneltide-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def reliable_checkpoint(df):
    """Write ``df`` to the shared checkpoint folder and return a DataFrame
    that reads it back (lineage cut, survives executor loss).

    The input is persisted for the duration of the write: an eager reliable
    checkpoint otherwise computes its input twice (once to run the action,
    once to write the files)."""
    from pyspark import StorageLevel

    checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's (read-only) parquet tables, listed afresh."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
