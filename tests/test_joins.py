"""Size-checked broadcast and the join operators."""

from pyspark.sql import functions as F

from paneltide.operators import joins as jn


def _is_broadcast(df) -> bool:
    return "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()


def test_measure_counts_rows_and_string_bytes(spark):
    dim = spark.createDataFrame([(1, "ab"), (2, "cdef"), (3, None)], "k int, name string")
    rows, size = jn.measure(dim)
    assert rows == 3
    # row overhead + 4-byte int + string length (NULL counts 0)
    assert size == 3 * (16 + 4) + 2 + 4


def test_broadcast_only_within_both_bounds(spark):
    dim = spark.createDataFrame([(i, "x" * 100) for i in range(50)], "k int, name string")
    assert _is_broadcast(jn.broadcast_if_small(dim))
    assert not _is_broadcast(jn.broadcast_if_small(dim, max_rows=49))
    assert not _is_broadcast(jn.broadcast_if_small(dim, max_bytes=50 * 100))


def test_attach_scalars_adds_one_row_of_statistics(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0)], "k int, x double")
    stats = df.agg(F.avg("x").alias("m"), F.max("x").alias("mx"))
    got = sorted((r.k, r.x, r.m, r.mx) for r in jn.attach_scalars(df, stats).collect())
    assert got == [(1, 2.0, 3.0, 4.0), (2, 4.0, 3.0, 4.0)]
    plan = jn.attach_scalars(df, stats)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan


def test_validate_keys_and_left_joins_keep_rows(spark):
    panel = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), (None, 1)], "k string, t int")
    other = spark.createDataFrame([("A", 1, 9.0)], "k string, t int, v double")
    out = jn.attach(panel, other, ["k", "t"]).collect()
    assert len(out) == 4 and sum(r.v is not None for r in out) == 1
    req = spark.createDataFrame([("A",), ("Z",)], "k string")
    assert [r.k for r in jn.validate_keys(req, panel, "k").collect()] == ["Z"]


def test_shuffle_partitions_sized_and_capped():
    from paneltide.session import shuffle_partitions_for

    assert shuffle_partitions_for(10 ** 6) == 200
    assert shuffle_partitions_for(10 * 1024 ** 4) == 40_960
    assert shuffle_partitions_for(100 * 1024 ** 4) == 100_000


class _StubContext:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self.set_to = master, ckpt, None

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, d):
        self.set_to = d


class _StubConf:
    def __init__(self):
        self.values = {}

    def get(self, k, default=None):
        return self.values.get(k, default)

    def set(self, k, v):
        self.values[k] = v


class _StubSession:
    def __init__(self, master, ckpt=None):
        self.sparkContext, self.conf = _StubContext(master, ckpt), _StubConf()


def test_checkpoint_dir_never_machine_local_on_a_cluster():
    import pytest

    from paneltide.session import checkpoint_dir

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_StubSession("yarn"))
    shared = _StubSession("yarn", ckpt="hdfs://shared/ckpt")
    assert checkpoint_dir(shared) == "hdfs://shared/ckpt" and shared.sparkContext.set_to == "hdfs://shared/ckpt"
    local = _StubSession("local[4]")
    assert checkpoint_dir(local).startswith("/") and local.conf.get("spark.checkpoint.dir")


def test_measure_counts_nested_values_by_their_content(spark):
    short = spark.createDataFrame([([1.0],)], "v array<double>")
    long = spark.createDataFrame([([float(i) for i in range(500)],)], "v array<double>")
    assert jn.measure(long)[1] > jn.measure(short)[1] + 500 * 3
