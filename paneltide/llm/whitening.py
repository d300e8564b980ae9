"""Embedding whitening with Spark MLlib's BlockMatrix.

Vector entries become whole numbers, so counts, sums and deviations are exact;
rows are centred as ``(n x - S) / n`` before any product. The centred rows,
numbered without gaps, become an IndexedRowMatrix and then a BlockMatrix of
blocks of ``rows_per_block`` rows. Its transpose times itself is the scatter,
the only thing (dims x dims numbers) that reaches the driver, where ``eigh``
takes it apart; the BlockMatrix times the whitening matrix (unit eigenvectors
over the roots of their eigenvalues) projects all rows. The whitened rows'
covariance is made by the same product and held against the identity.

A product with one result block would otherwise bring all rows to one task, so
the products take MLlib's ``numMidDimSplits``: about ``SPLIT_ROWS`` rows go to
one task, whose dims x dims partial products are summed. PySpark's
``multiply`` lacks that argument, so the same method is called with it on the
wrapped matrix.

Defined results: a vector that is null, or holds a null, a non-finite entry or
one of 2**42 and more (whose whole numbers a long sum could not hold), is
dropped; a null id stays null, rows with equal ids are rows of their own;
shorter vectors are padded with entries 0.0; a deviation beyond a long is null;
components without variance (eigenvalue 0 to double precision) don't exist, so
one row, or equal rows, give none; no rows give no rows; other columns are not
read. A component's sign makes its largest entry positive.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import store
from paneltide.operators.joins import broadcast_if_small

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
ROWS_PER_BLOCK = 1024
SPLIT_ROWS = 65_536
MOST_BLOCKS = 1_000_000  # block coordinates are known to the driver
LIMIT = float(2**42)
PLACES = 33  # bits of a row's place in monotonically_increasing_id


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``index``, 0 .. n-1: a row's place in its written partition plus
    the rows of the partitions before. The table is written with the places."""
    rows = store.materialise(rows.withColumn("place", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("place", PLACES).alias("part")
    offsets = store.partition_offsets(rows.groupBy(part).agg(F.count("*").alias("size")), "part", "size", "before")
    index = F.col("before") + F.col("place").bitwiseAND(F.lit(2**PLACES - 1))
    return rows.withColumn("part", part).join(broadcast_if_small(offsets), "part").withColumn("index", index).drop("part", "before", "place")


def whole(table: DataFrame, id_col: str, vec_col: str, scale: int, shift: int) -> DataFrame:
    """(id, x): the vectors that take part, as longs."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT)
    rows = table.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("v").isNotNull() & F.forall("v", entry))
    return rows.select("id", F.transform("v", lambda c: F.floor(c * scale) + shift).alias("x"))


def blocks_of(rows: DataFrame, values: str, n: int, dims: int) -> BlockMatrix:
    """The BlockMatrix of ``rows`` (index, array<double>)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(values).alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(max(ROWS_PER_BLOCK, -(-n // MOST_BLOCKS)), dims)


def product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix, n: int) -> np.ndarray:
    """matrix' matrix, dims x dims."""
    s = product(matrix.transpose(), matrix, -(-n // SPLIT_ROWS)).toLocalMatrix().toArray()
    return (s + s.T) / 2


def axes(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues and their unit eigenvectors (columns)."""
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    real = values > np.trace(covariance) * len(covariance) * 4 * np.finfo(float).eps
    values, vectors = values[real], vectors[:, real]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def _deviation(x: Column, sums: Column, n: int, exact: bool) -> Column:
    if exact:  # no step leaves the longs
        return F.aggregate(F.zip_with(x, sums, lambda a, s: (a * n - s) * (a * n - s)), F.lit(0).cast("long"), lambda acc, v: acc + v)
    big = lambda c: c.cast("decimal(38,0)")
    off = F.zip_with(x, sums, lambda a, s: F.try_subtract(big(F.try_multiply(big(a), F.lit(n).cast("decimal(19,0)"))), big(s)))
    square = F.aggregate(off, big(F.lit(0)), lambda acc, v: big(F.try_add(acc, big(F.try_multiply(v, v)))))
    return square.try_cast("long")


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Per remaining row and component: id, component, n, deviation, whitened,
    explained, identity_error."""
    spark = table.sparkSession
    rows = numbered(whole(table, id_col, vec_col, scale, shift))
    n, dims = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    schema = f"`{id_col}` {table.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not n or not dims:
        return spark.createDataFrame([], schema)
    padded = F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(dims) - F.size("x")))
    rows = rows.withColumn("x", padded)
    entries = rows.select(F.posexplode("x").alias("dim", "x")).groupBy("dim").agg(
        F.sum(F.col("x").cast("decimal(19,0)")).alias("s"), F.min("x").alias("least"), F.max("x").alias("most"))
    per_dim = sorted(entries.collect())  # one row for each dimension
    sums = [int(r["s"]) for r in per_dim]
    reach = max(max(n * r["most"] - s, s - n * r["least"]) for r, s in zip(per_dim, sums))
    steps = n * max(max(abs(r["most"]), abs(r["least"])) for r in per_dim)
    exact = dims * reach * reach < 2**63 and steps + reach < 2**63 and max(map(abs, sums)) < 2**63
    total = F.lit(sums) if exact else F.array(*(F.lit(str(s)).cast("decimal(38,0)") for s in sums))
    if exact:
        centred = F.zip_with("x", total, lambda a, s: (a * n - s).cast("double") / n)
    else:
        centred = F.zip_with("x", F.lit([s / n for s in sums]), lambda a, m: a.cast("double") - m)
    matrix = blocks_of(rows.select("index", centred.alias("c")), "c", n, dims)
    covariance = scatter(matrix, n) / n
    values, vectors = axes(covariance, components)
    kept = len(values)
    if not kept:
        return spark.createDataFrame([], schema)
    whitening = vectors / np.sqrt(values)
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), Matrices.dense(dims, kept, whitening.ravel("F").tolist()))], 1), dims, kept)
    projected = product(matrix, right).toIndexedRowMatrix()
    # what IndexedRowMatrix.rows reads, without a detour of the rows through Python
    z = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model).toDF("index", "vector")
    z = store.materialise(z.select("index", vector_to_array("vector").alias("z")), "whitened")
    means = F.array(*(F.avg(F.get("z", F.lit(k))) for k in range(kept)))
    mean = list(z.agg(means).first()[0])
    again = blocks_of(z.select("index", F.zip_with("z", F.lit(mean), lambda a, m: a - m).alias("c")), "c", n, kept)
    error = float(np.abs(scatter(again, n) / n - np.eye(kept)).max())
    share = (values / np.trace(covariance)).tolist()
    out = rows.select("index", "id", _deviation(F.col("x"), total, n, exact).alias("deviation")).join(z, "index")
    out = out.select("id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return out.select(F.col("id").alias(id_col), (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      F.get(F.lit(share), F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))


def q_op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(store.read(spark, sf_dir, "embeddings"))
