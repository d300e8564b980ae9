"""Searching a stated set of queries among all vectors, in blocks.

Vectors are hashed into shards of about ``shard_rows`` rows, and an operator
builds its index for each. Queries are hashed into blocks of about
``query_rows``; where shards are few, smaller blocks keep all cores busy.
Every (shard, block) pair is one row of a join on both numbers and is searched
by itself, so neither side is broadcast or gathered; a pair returns k rows for
each of its queries, and a ranked window merges the shards.

Rows are numbered once, in the table they are written to. A shard holds its
rows by id and number, and an index knows them by their places: the smaller
place is the smaller id, and a query's own row is one place, so rows that
repeat an id, or are equal in all, are candidates like others.

Defined results, for both users: rows with a null id, and vectors that are
null or hold null or non-finite components, take no part; rows with equal ids
are rows of their own, as queries too; shorter vectors are padded with zeros; with
fewer than k other vectors all are returned; no vectors give no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store


def vectors(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, row): the vectors that take part, as doubles, numbered."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite))
    return store.materialise(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _matrix(column, dims: int) -> np.ndarray:
    rows = [np.asarray(v, np.float64) for v in column]
    out = np.zeros((len(rows), dims))
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def search(rows: DataFrame, is_query, k: int, build: Callable[[np.ndarray, np.ndarray], bytes],
           find: Callable[[bytes, np.ndarray, np.ndarray, int], tuple], score_type: str,
           shard_rows: int, query_rows: int) -> DataFrame:
    """``build(places, matrix)`` makes a shard's index, ``find(index, own
    places, query matrix, k)`` returns (query position, place, score) arrays of
    each query's k best of the shard, its own place (-1: elsewhere) left out."""
    n, dims, asked = rows.agg(F.count("*"), F.max(F.size("v")), F.sum(is_query.cast("long"))).first()
    shards, dims, asked = n // shard_rows + 1, dims or 1, asked or 0
    busy = -(-2 * rows.sparkSession.sparkContext.defaultParallelism // shards)
    blocks = max(asked // (64 * query_rows) + 1, min(asked // query_rows + 1, busy))
    kind = {"long": pa.int64(), "double": pa.float64()}[score_type]

    def index(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "row"])
        ids, own = (pdf[c].to_numpy("<i8").tobytes() for c in ("id", "row"))
        return pd.DataFrame({"shard": [key[0]], "index": [build(np.arange(len(pdf)), _matrix(pdf["v"], dims))], "ids": [ids], "own": [own]})

    def block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["id", "row"])
        ids, own = (pdf[c].to_numpy("<i8").tobytes() for c in ("id", "row"))
        return pd.DataFrame({"block": [key[0]], "query_ids": [ids], "query_rows": [own], "queries": [_matrix(pdf["v"], dims).tobytes()]})

    def pairs(batches):
        longs = lambda batch, c, r: np.frombuffer(batch.column(c)[r].as_buffer(), "<i8")
        for batch in batches:
            for r in range(batch.num_rows):
                ids, own, query_ids, query = (longs(batch, c, r) for c in ("ids", "own", "query_ids", "query_rows"))
                order = np.argsort(own)
                place = order[np.searchsorted(own, query, sorter=order) % len(own)]
                place = np.where(own[place] == query, place, -1)
                queries = np.frombuffer(batch.column("queries")[r].as_buffer()).reshape(-1, dims)
                at, vec, score = find(batch.column("index")[r].as_py(), place, queries, k)
                yield pa.RecordBatch.from_arrays([pa.array(query[at]), pa.array(query_ids[at]), pa.array(ids[vec]), pa.array(score, kind)],
                                                 ["query", "query_id", "vec_id", "score"])

    part = lambda m: F.pmod(F.xxhash64("row"), F.lit(m)).cast("int")
    indexed = rows.withColumn("shard", part(shards)).groupBy("shard").applyInPandas(index, "shard int, index binary, ids binary, own binary")
    asking = rows.filter(is_query).withColumn("block", part(blocks)).groupBy("block").applyInPandas(
        block, "block int, query_ids binary, query_rows binary, queries binary")
    left = indexed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = left.join(right, ["shard", "block"]).mapInArrow(pairs, f"query long, query_id long, vec_id long, score {score_type}")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best, ties to the smaller id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= cut)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]
