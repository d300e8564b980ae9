"""Sharding by longest processing time: groups that must stay together, the
largest first, each go to the shard with the least so far.

Only groups above a ``1 / (shards * grain)`` share of all bytes are placed one
by one; there are at most ``shards * grain`` of them. The others are first
hashed into ``shards * grain`` bundles, which are placed like groups. So the
heap works on a bounded list whatever the corpus, no shard differs from the
others by much more than one bundle, and rows find their shard by a broadcast
of that bounded list, without a shuffle and without gathering a group.

Defined results: null and empty texts are one group of no bytes; rows with
equal ids are rows of their own; a group larger than a shard's share makes its
shard larger than the others (it must stay together); no documents give no
rows; columns other than id and text are not read.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store

ROW_BYTES = 8
NUMBERED = 50_000  # rows that get their slots in one task, about


def longest_first(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """item -> shard; ties by item, then by the smaller shard."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, s = heap[0]
        out[item] = s
        heapq.heapreplace(heap, (load + size, s))
    return out


def assign(rows: DataFrame, shards: int, grain: int = 1024) -> DataFrame:
    """``rows`` has ``grp`` (what stays together) and ``size``; adds ``shard``."""
    n = shards * grain
    total = rows.agg(F.sum("size")).first()[0] or 0
    bundle = F.concat(F.lit("bundle "), F.pmod(F.xxhash64("grp"), F.lit(n)).cast("string"))
    groups = rows.groupBy("grp").agg(F.sum("size").alias("size"))
    item = F.when(F.col("size") * n > total, F.col("grp")).otherwise(bundle)
    # at most n groups exceed total / n, and there are n bundles
    items = groups.groupBy(item.alias("item")).agg(F.sum("size").alias("size"))
    placed = longest_first([(r["item"], r["size"]) for r in items.collect()], shards)
    table = rows.sparkSession.createDataFrame(list(placed.items()), "item string, shard int")
    own = table.select(F.col("item").alias("grp"), F.col("shard").alias("own"))
    out = rows.join(F.broadcast(own), "grp", "left").withColumn("item", bundle)
    return out.join(F.broadcast(table), "item", "left").withColumn("shard", F.coalesce("own", "shard")).drop("item", "own")


def number(rows: DataFrame, order: list[str], count: int) -> DataFrame:
    """Slots in each shard, gapless from 0. A shard's rows are numbered in
    hashed parts, whose offsets are sums of the smaller parts' counts."""
    parts = count // NUMBERED + 1
    rows = rows.withColumn("sub", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    before = W.partitionBy("shard").orderBy("sub").rowsBetween(W.unboundedPreceding, -1)
    first = rows.groupBy("shard", "sub").agg(F.count("*").alias("n")).select(
        "shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    numbered = rows.withColumn("k", F.row_number().over(W.partitionBy("shard", "sub").orderBy(*order)) - 1)
    return numbered.join(first, ["shard", "sub"]).withColumn("slot", F.col("first") + F.col("k")).drop("sub", "first", "k")


def shard_documents(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = store.materialise(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.sha2(text, 256).alias("grp")), "sharding")
    return number(assign(slim, shards), ["doc_id", "grp"], slim.count()).drop("grp")


def q_op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(store.read(spark, sf_dir, "documents"), shards=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
