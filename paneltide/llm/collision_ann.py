"""Approximate nearest neighbours by collision counting.

Unit vectors are projected on ``PROJECTIONS`` random lines, and each line's
values are kept as one sorted array. A query's window on each line is centred
on its own projection; virtual rehashing widens all windows by a factor, and
only the newly covered ends are counted. A row inside the windows of at least
``SHARE`` of the lines has collided often enough and becomes a candidate.
Widening ends when there are ``k + BASE + PART * n`` candidates in the shard
(or when all rows are), and the candidates' cosines are computed exactly.

Every row is indexed and every candidate is verified; recall depends on PART
and PROJECTIONS and is measured against brute force in the tests. Zero vectors
take no part (they have no direction).
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import store, vector_blocks

PROJECTIONS = 128
SHARE = 0.5
WIDEN = 1.2
FIRST = 0.25
BASE, PART = 64, 0.15


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Each row over a power of two near its largest entry, which changes no
    digit of a cosine and keeps squares from over- or underflowing."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(axis=1, keepdims=True))[1])


def build(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    matrix = scaled(matrix)
    norm = np.sqrt((matrix * matrix).sum(1))
    lines = np.random.default_rng(5).normal(size=(matrix.shape[1], PROJECTIONS))
    p = (matrix / norm[:, None]) @ lines
    order = np.argsort(p, axis=0, kind="stable")
    short = matrix.astype(np.float32)  # as it came, if it came as floats
    return pickle.dumps((ids, short if (short == matrix).all() else matrix, norm, lines, np.ascontiguousarray(order.T, np.int32),
                         np.ascontiguousarray(np.take_along_axis(p, order, 0).T, np.float32)), protocol=5)


def candidates(order: np.ndarray, values: np.ndarray, centre: np.ndarray, most: int) -> np.ndarray:
    n, lines = order.shape[1], len(order)
    need = int(np.ceil(SHARE * lines))
    hits = np.zeros(n, np.int64)
    lo = hi = None
    half = FIRST
    while True:
        # ends of the values' own type: else each search would convert its array
        low, high = (centre - half).astype(values.dtype), (centre + half).astype(values.dtype)
        a = [int(values[j].searchsorted(low[j])) for j in range(lines)]
        b = [int(values[j].searchsorted(high[j], side="right")) for j in range(lines)]
        if lo is None:
            new = [order[j, a[j]: b[j]] for j in range(lines)]
        else:
            new = [x for j in range(lines) for x in (order[j, a[j]: lo[j]], order[j, hi[j]: b[j]])]
        hits += np.bincount(np.concatenate(new), minlength=n)
        lo, hi = a, b
        found = np.flatnonzero(hits >= need)
        if len(found) >= min(most, n):
            return found
        if not any(a) and all(e == n for e in b):  # the windows hold all rows
            return np.arange(n)
        half *= WIDEN


def find(data: bytes, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
    ids, matrix, norm, lines, order, values = pickle.loads(data)
    at, vec, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    for i, (own, q) in enumerate(zip(query_ids.tolist(), scaled(queries))):
        size = np.sqrt((q * q).sum())
        # "most" counts the query itself if it lies in this shard
        near = candidates(order, values, (q / size) @ lines, k + BASE + int(PART * len(ids)))
        near = near[ids[near] != own]
        cosine = (matrix[near].astype(np.float64) * q).sum(1) / (norm[near] * size)
        found = vector_blocks.best(ids[near], cosine, k)
        at.append(np.full(len(found), i))
        vec.append(ids[near][found])
        score.append(cosine[found])
    return np.concatenate(at), np.concatenate(vec), np.concatenate(score)


def search(table: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found by cosine.
    ``is_query`` is a condition on the column ``id``."""
    rows = vector_blocks.vectors(table, id_col, vec_col).filter(F.exists("v", lambda x: x != 0))
    return vector_blocks.search(rows, is_query, k, build, find, "double", shard_rows=32_768, query_rows=512)


def q_op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(store.read(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
