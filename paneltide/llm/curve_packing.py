"""Packing along a Hilbert curve.

Each text becomes a hashed vector of its byte four-grams; a fixed random
projection takes it to a few dimensions, and the Hilbert index of the point
sorts documents so that similar ones are neighbours. The documents' tokens,
laid end to end in that order, are cut at every ``length`` tokens. Cutting is
free, so the only short sequences are the last ones: what is left over at the
end is cut into sequences whose lengths are powers of two.

The order is one range partitioning of the whole corpus: no neighbourhood is
ever gathered, and a hot key is split by id. The encoded documents are written
once in curve order with their place in the partition; the cut needs only the
partitions' totals (one row each) besides.

Defined results: a null or empty text has the end id alone; equal keys follow
by id, then by the text's hash; null ids stay null in the pieces; no documents
give no pieces; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm import store, tokens

BUCKETS, DIMS, BITS = 256, 4, 12
_STEP = 0x9E3779B1
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of integer points (rows) with coordinates
    below 2**bits, by the transpose method of Skilling (2004)."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for d in range(dims):
            hit = (x[:, d] & q) != 0
            swap = np.where(hit, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(hit, low, swap)
            x[:, d] ^= swap
        q >>= 1
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[:, -1] & q, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[:, d] >> bit & 1)
    return key


def hashed_vector(text: bytes) -> np.ndarray:
    """Damped, normalised counts of the text's hashed byte four-grams."""
    b = np.frombuffer(text, np.uint8)
    if len(b) < 4:
        b = np.concatenate([b, np.zeros(4 - len(b), np.uint8)])
    b = b.astype(np.uint32)
    b *= np.uint32(0x85EBCA6B)
    pair = b[:-1] * np.uint32(_STEP)
    pair += b[1:]
    gram = pair[:-2] * np.uint32(_STEP * _STEP & 0xFFFFFFFF)  # a four-gram is two pairs
    gram += pair[2:]
    gram >>= np.uint32(24)
    v = np.log1p(np.bincount(gram, minlength=BUCKETS))
    return v / np.sqrt(v @ v)


def _projection() -> np.ndarray:
    p = np.random.default_rng(17).normal(size=(BUCKETS, DIMS))
    return p - p.mean(0)  # drops the part that all texts share


def curve_keys(texts: list[bytes]) -> np.ndarray:
    points = np.array([hashed_vector(t) for t in texts]) @ _projection()
    level = np.tanh(points) * 0.5 + 0.5
    return hilbert_key(np.minimum((level * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


@F.arrow_udf(T.LongType())
def _key(texts: pa.Array) -> pa.Array:
    out = [curve_keys([t.encode("utf-8", "replace") for t in part]) for _, part in tokens.texts_of(texts)]
    return pa.array(np.concatenate(out) if out else np.empty(0, np.int64), pa.int64())


def _encode(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches):
        from pyspark import TaskContext

        part, at, enc = TaskContext.get().partitionId(), 0, tokens.encoder(path)
        for batch in batches:
            ids = batch.column(0)
            for first, texts in tokens.texts_of(batch.column(1)):
                got = [b + end for b in enc.encode(texts)]
                n = np.array([len(b) // 4 for b in got], np.int64)
                start = at + np.cumsum(n) - n
                at += int(n.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(got), part), pa.int32()), pa.array(start), ids.slice(first, len(got)), pa.array(n),
                     pa.array([np.frombuffer(b, "<u4").astype("<u2").tobytes() for b in got], pa.binary())],
                    ["part", "at", "doc_id", "n", "ids"])

    return rows


def _cutter(length: int, total: int, with_ids: bool):
    full = total // length
    tail, rest = [], total - full * length
    for k in range(rest.bit_length() - 1, -1, -1):
        if rest >> k & 1:
            tail.append((tail[-1] if tail else full * length) + (1 << k))
    tail = np.array(tail, np.int64)  # ends of the sequences after the full ones

    def rows(batches):
        for batch in batches:
            starts, ns, ids = (batch.column(k) for k in ("position", "n", "ids"))
            out: list[tuple] = []
            for row, (p, n) in enumerate(zip(starts.to_pylist(), ns.to_pylist())):
                cuts = np.arange(p // length * length + length, min(p + n, full * length + 1), length)
                cuts = np.concatenate([[p], cuts[cuts > p], tail[(tail > p) & (tail < p + n)], [p + n]])
                cuts = np.unique(cuts)
                data = memoryview(np.frombuffer(ids[row].as_buffer(), "<u2").astype("<u4").tobytes())
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    if a < full * length:
                        seq, base = a // length, a // length * length
                    else:
                        k = int(np.searchsorted(tail, a, side="right"))
                        seq, base = full + k, int(tail[k - 1]) if k else full * length
                    piece = data[4 * (a - p): 4 * (b - p)]
                    out.append((row, a - p, b - a, zlib.crc32(piece), n, seq, a - base, bytes(piece) if with_ids else None))
            cols = list(zip(*out)) if out else [[]] * 8
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(cols[0], pa.int64()))] + [pa.array(c, t) for c, t in zip(cols[1:], kinds)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    return rows


def pack(docs: DataFrame, tokenizer: str, end_id: int, length: int = 1024, with_ids: bool = True,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: which ids of a document lie where in which
    sequence, with the ids (little-endian u4) if asked for. ``tokenizer`` has
    fewer than 65,536 ids."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    rows = rows.withColumn("key", _key("t"))
    order = ["key", "id", F.xxhash64("t")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "t")
    laid = store.materialise(rows.mapInArrow(_encode(tokenizer, end_id), "part int, at long, doc_id long, n long, ids binary"), "packed")
    sizes = laid.groupBy("part").agg(F.sum("n").alias("n"))
    base = store.partition_offsets(sizes, "part", "n", "base")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    placed = laid.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("position"), "n", "ids")
    return placed.mapInArrow(_cutter(length, total, with_ids), PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences: ids in order, and the documents they come from."""
    held = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("held"))
    return held.select(
        "sequence_id", F.transform("held", lambda p: p.doc_id).alias("doc_ids"),
        F.aggregate("held", F.lit(b"").cast("binary"), lambda acc, p: F.concat(acc, p.ids)).alias("ids"))


def q_op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.read(spark, sf_dir, "documents")
    return pack(docs, tokens.tokenizer_path("byte_bpe_50k.json"), end_id=0, with_ids=False).drop("ids")
