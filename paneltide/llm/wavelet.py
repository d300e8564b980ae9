"""Token-id output as one wavelet matrix per shard file.

Documents are range-partitioned and sorted by id. Each task encodes its texts
and closes a shard at the first document end at or past ``shard_tokens``
tokens. A shard is one Parquet file with one row: the documents' ids and
lengths, and the wavelet matrix of all its tokens as bytes (the layout is in
``WaveletMatrix.to_bytes``). Spark writes and commits the files, so a lost
executor's shards are written again under the same name and nothing half
written is read. From a file alone one gets tokens by position, counts of a
token in a range, and the positions of its occurrences.

Defined results: a null or empty text has the end id alone; rows with equal
ids follow each other in the order of their texts' hashes; null ids come
first; no documents give no shards; columns other than id and text are not
read. A document is never split, so a shard holds its longest text whole.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store, tokens

_MAGIC = b"WVM1"
_BLOCK = 512  # bits between two stored ranks
_STRETCH = 1 << 15  # tokens parted at a time, so that they stay in the cache
SHARD_SCHEMA = "part int, seq int, n_tokens long, doc_ids binary, id_nulls binary, lengths binary, matrix binary"


def _stretches(bit: np.ndarray, n_zeros: int):
    """Per stretch of the bits its first place, where in it zeros are and where
    they go in the parted sequence, and the same of ones."""
    at_0, at_1 = 0, n_zeros
    for k in range(0, len(bit), _STRETCH):
        part = bit[k: k + _STRETCH]
        zeros, ones = np.flatnonzero(~part), np.flatnonzero(part)
        yield k, zeros, at_0, ones, at_1
        at_0 += len(zeros)
        at_1 += len(ones)


class WaveletMatrix:
    """Bit planes of a sequence, the highest bit first; after each plane the
    sequence is parted stably by the bit. ``ranks`` has the ones before every
    block of 512 bits."""

    def __init__(self, n: int, planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.zeros = [n - int(r[-1]) for r in ranks]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int | None = None) -> "WaveletMatrix":
        ids = np.ascontiguousarray(ids)
        if levels is None:
            levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, ranks = [], []
        cur, parted = ids.copy(), np.empty_like(ids)
        for level in range(levels - 1, -1, -1):
            bit = (cur >> level & 1).astype(bool)
            plane = np.packbits(bit)
            planes.append(plane)
            padded = np.zeros(-(-len(plane) // 64) * 64, np.uint8)
            padded[: len(plane)] = plane
            ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, 8).sum(1, dtype=np.int64)
            ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.int64))
            for k, zeros, at_0, ones, at_1 in _stretches(bit, len(ids) - int(ranks[-1][-1])):
                part = cur[k: k + _STRETCH]
                parted[at_0: at_0 + len(zeros)] = part[zeros]
                parted[at_1: at_1 + len(ones)] = part[ones]
            cur, parted = parted, cur
        return cls(len(ids), planes, ranks)

    def to_bytes(self) -> bytes:
        """magic, levels u4, n u8; then per level the plane's bytes and its
        ranks as u4 (a shard has fewer than 2**32 tokens)."""
        parts = [_MAGIC, struct.pack("<IQ", len(self.planes), self.n)]
        for p, r in zip(self.planes, self.ranks):
            parts += [p.tobytes(), r.astype("<u4").tobytes()]
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> "WaveletMatrix":
        if data[:4] != _MAGIC:
            raise ValueError("not a wavelet matrix")
        levels, n = struct.unpack_from("<IQ", data, 4)
        at, width, blocks = 16, -(-n // 8), -(-(-(-n // 8)) // 64) + 1
        planes, ranks = [], []
        for _ in range(levels):
            planes.append(np.frombuffer(data, np.uint8, width, at))
            at += width
            ranks.append(np.frombuffer(data, "<u4", blocks, at).astype(np.int64))
            at += 4 * blocks
        return cls(n, planes, ranks)

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return self.planes[level][i >> 3] >> (7 - (i & 7)) & 1

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        block = i // _BLOCK
        out = self.ranks[level][block].copy()
        plane, at, end = self.planes[level], block * (_BLOCK // 8), i >> 3
        for step in range(_BLOCK // 8):
            pos = at + step
            live = pos < end
            if not live.any():
                break
            out[live] += np.bitwise_count(plane[pos[live]])
        rest = i & 7
        live = rest > 0
        out[live] += np.bitwise_count(plane[end[live]] >> (8 - rest[live]).astype(np.uint8))
        return out

    def access(self, positions) -> np.ndarray:
        """The ids at the positions."""
        i = np.atleast_1d(np.asarray(positions, np.int64))
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.planes)):
            bit = self._bit(level, i).astype(np.int64)
            ones = self._rank1(level, i)
            out = out << 1 | bit
            i = np.where(bit == 1, self.zeros[level] + ones, i - ones)
        return out

    def _range(self, symbol: int, start: int, end: int) -> tuple[int, int]:
        lo = np.array([start, end], np.int64)
        for level in range(len(self.planes)):
            ones = self._rank1(level, lo)
            lo = self.zeros[level] + ones if symbol >> (len(self.planes) - 1 - level) & 1 else lo - ones
        return int(lo[0]), int(lo[1])

    def rank(self, symbol: int, end: int) -> int:
        """Occurrences of the id before position ``end``."""
        return self.count(symbol, 0, end)

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        if symbol < 0 or symbol >> len(self.planes):
            return 0
        a, b = self._range(symbol, start, self.n if end is None else end)
        return b - a

    def _select_bit(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Position of the k-th (from 0) bit of that value."""
        ranks = self.ranks[level]
        ends = np.minimum(np.arange(len(ranks)) * _BLOCK, self.n)
        seen = ranks if bit else ends - ranks
        block = np.searchsorted(seen, k, side="right") - 1
        lo, hi = ends[block], np.minimum(ends[block] + _BLOCK, self.n)
        while (hi - lo > 1).any():
            mid = (lo + hi) // 2
            ones = self._rank1(level, mid)
            left = (ones if bit else mid - ones) > k
            hi, lo = np.where(left, mid, hi), np.where(left, lo, mid)
        return lo

    def occurrences(self, symbol: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Positions of the id in [start, end), ascending: select on the way up."""
        if symbol < 0 or symbol >> len(self.planes) or not self.n:
            return np.empty(0, np.int64)
        a, b = self._range(symbol, start, self.n if end is None else end)
        i = np.arange(a, b, dtype=np.int64)
        for level in range(len(self.planes) - 1, -1, -1):
            if symbol >> (len(self.planes) - 1 - level) & 1:
                i = self._select_bit(level, 1, i - self.zeros[level])
            else:
                i = self._select_bit(level, 0, i)
        return i

    def select(self, symbol: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence, -1 if there are fewer."""
        found = self.occurrences(symbol)
        return int(found[k]) if k < len(found) else -1

    def decode(self) -> np.ndarray:
        """The whole sequence, by undoing the partitions from the last plane up."""
        out, up = np.zeros((2, self.n), np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n).view(bool)
            out[self.zeros[level]:] |= out.dtype.type(1 << (len(self.planes) - 1 - level))
            for k, zeros, at_0, ones, at_1 in _stretches(bit, self.zeros[level]):
                part = up[k: k + _STRETCH]
                part[zeros] = out[at_0: at_0 + len(zeros)]
                part[ones] = out[at_1: at_1 + len(ones)]
            out, up = up, out
        return out


def _shard_writer(path: str, end_id: int, shard_tokens: int):
    def shards(batches):
        from pyspark import TaskContext

        part, seq, enc = TaskContext.get().partitionId(), 0, tokens.encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        ids, nulls, held, size = [], [], [], 0

        def close():
            nonlocal ids, nulls, held, size, seq
            seqs = np.frombuffer(b"".join(held), "<u4")
            lengths = np.array([len(b) // 4 for b in held], "<i8")
            row = {"part": [part], "seq": [seq], "n_tokens": [size], "doc_ids": [np.array(ids, "<i8").tobytes()],
                   "id_nulls": [np.packbits(np.array(nulls, bool)).tobytes()], "lengths": [lengths.tobytes()],
                   "matrix": [WaveletMatrix.build(seqs if end_id > 65535 or seqs.max() > 65535 else seqs.astype(np.uint16)).to_bytes()]}
            ids, nulls, held, size, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([
                ("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("doc_ids", pa.binary()),
                ("id_nulls", pa.binary()), ("lengths", pa.binary()), ("matrix", pa.binary())]))

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for first, texts in tokens.texts_of(batch.column(1)):
                for k, b in enumerate(enc.encode(texts)):
                    i = doc_ids[first + k]
                    ids.append(0 if i is None else i)
                    nulls.append(i is None)
                    held.append(b + end)
                    size += len(b) // 4 + 1
                    if size >= shard_tokens:
                        yield close()
        if held:
            yield close()

    return shards


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = 1 << 22,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the documents in ascending id order and write the shard files."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    rows = rows.repartitionByRange("id", F.xxhash64("t")).sortWithinPartitions("id", F.xxhash64("t"))
    (rows.mapInArrow(_shard_writer(tokenizer, end_id, shard_tokens), SHARD_SCHEMA)
        .write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path))


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shard files with ``first``: the tokens in all files before."""
    table = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = table.select("part", "seq", "n_tokens")
    base = store.partition_offsets(sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")), "part", "n", "base")
    before = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    local = sizes.select("part", "seq", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("local"))
    first = local.join(base, "part").select("part", "seq", (F.col("base") + F.col("local")).alias("first"))
    return table.join(first, ["part", "seq"])


def _decoded(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].as_py()  # noqa: E731, B023
            ids = np.frombuffer(get("doc_ids"), "<i8")
            null = np.unpackbits(np.frombuffer(get("id_nulls"), np.uint8), count=len(ids)).astype(bool)
            lengths = np.frombuffer(get("lengths"), "<i8")
            seq = WaveletMatrix.from_bytes(get("matrix")).decode().astype("<u4").tobytes()
            ends = np.cumsum(lengths)
            starts = ends - lengths
            yield ids, null, starts, lengths, seq


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, its place, and its ids (little-endian u4)."""

    def rows(batches):
        for ids, null, starts, lengths, seq in _decoded(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, mask=null), pa.array(starts), pa.array(lengths),
                 pa.array([seq[4 * a: 4 * (a + n)] for a, n in zip(starts.tolist(), lengths.tolist())], pa.binary())],
                ["doc_id", "local", "n_tokens", "ids"])

    return spark.read.schema(SHARD_SCHEMA).parquet(path).mapInArrow(rows, "doc_id long, local long, n_tokens long, ids binary")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32."""

    def rows(batches):
        for batch in batches:
            for k, (ids, null, starts, lengths, seq) in enumerate(_decoded([batch])):
                view = memoryview(seq)
                crc = [zlib.crc32(view[4 * a: 4 * (a + n)]) for a, n in zip(starts.tolist(), lengths.tolist())]
                same = np.full(len(ids), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(same * batch.column("part")[k].as_py(), pa.int32()), pa.array(same * batch.column("seq")[k].as_py(), pa.int32()),
                     pa.array(ids, mask=null), pa.array(starts), pa.array(lengths), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"])

    firsts = shards(spark, path).select("part", "seq", "first")
    table = spark.read.schema(SHARD_SCHEMA).parquet(path)
    out = table.mapInArrow(rows, "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return out.join(F.broadcast(firsts), ["part", "seq"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, path: str, symbol: int) -> DataFrame:
    """Per shard: how often the token id occurs, and its global positions."""

    def rows(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                at = WaveletMatrix.from_bytes(batch.column("matrix")[row].as_py()).occurrences(symbol)
                at = at + batch.column("first")[row].as_py()
                yield pa.RecordBatch.from_pydict({"first": [batch.column("first")[row].as_py()], "n": [len(at)], "positions": [at.tolist()]},
                                                 schema=pa.schema([("first", pa.int64()), ("n", pa.int64()), ("positions", pa.list_(pa.int64()))]))

    return shards(spark, path).select("first", "matrix").mapInArrow(rows, "first long, n long, positions array<long>")


def q_op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = store.scratch(spark, "wavelet")
    write_shards(store.read(spark, sf_dir, "documents"), path, tokens.tokenizer_path("word_bpe_49k.json"), end_id=1)
    return digests(spark, path)
