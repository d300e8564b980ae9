"""Long repeated strings by run-length indexes.

A byte is removed when a string of ``length`` bytes that covers it also starts
earlier. Equal strings hold equal k-grams, so each string is found by its
least k-gram hash (a minimizer): an anchor. An anchor's context is all bytes
that a string with that k-gram at its place can reach.

Occurrences of anchors are grouped by k-gram. Within a group, occurrences with
equal contexts but the first are covered whole: such copies are settled by a
hash, in the map tasks already where they meet there. What is left are the
first occurrences of different contexts of one k-gram. Their bytes go, bucket
by bucket, into a run-length index: a Burrows-Wheeler transform as runs, with
text positions sampled at run ends and with marks where the sorted suffixes
stop sharing ``length`` bytes. All contexts are streamed through the index
backwards; a step's place tells with which suffixes the next ``length`` bytes
match, so the matching statistic (cut at ``length``) is read off, and strings
whose earliest match starts before them are marked.

A k-gram with more than ``HOT`` different contexts is not gathered: its strings
are grouped by their own hashes instead, with map-side aggregation.

Defined results: texts shorter than ``length`` keep all bytes; rows with equal
ids are ordered by a hash of their texts, and rows with equal ids and texts
count as one document (each gets its result); null ids come first; no documents
give no rows; columns other than id and text are not read.
"""

from __future__ import annotations


from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store

GRAM = 40
SLICE = 1_000_000  # bytes hashed at a time
BLOCK = 1_000_000  # context bytes in one index; up to 2**21, its suffixes are sorted as single numbers
HOT = 20_000
_rng = np.random.default_rng(23)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class Hashes:
    """Hashes of any substrings of a buffer, by sums of weighted bytes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(20, len(data).bit_length())
        up, self.down = _powers(size)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])

    def of(self, start, end):
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _slide(x: np.ndarray, width: int, take) -> np.ndarray:
    """take (minimum or maximum) over every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = take(x[:-have], x[have:])
        have *= 2
    return take(x[: len(x) - (width - have)], x[width - have:]) if width > have else x


def anchors(data: np.ndarray, windows: list[tuple[int, int]], length: int) -> tuple[np.ndarray, Hashes]:
    """Places of the k-grams that are least in some string whose start lies in
    one of the ranges; all of equal ones."""
    h = Hashes(data)
    starts = np.arange(len(data) - GRAM + 1)
    x = _mix(h.of(starts, starts + GRAM)) | np.uint64(1)
    width = length - GRAM + 1
    least = _slide(x, width, np.minimum)
    edge = np.zeros(len(least) + 1, np.int64)
    for a, b in windows:
        edge[a] += 1
        edge[b] -= 1
    least[np.cumsum(edge)[:-1] == 0] = 0
    pad = np.zeros(width - 1, np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), width, np.maximum)
    return np.flatnonzero(most == x), h


def occurrences(texts: list[bytes], length: int):
    """(text number, place, k-gram hash, context hash) of the texts' anchors.
    Long texts are hashed in overlapping pieces."""
    reach = length - GRAM
    pieces = []  # text, first byte, bytes, first and end of the string starts
    for i, t in enumerate(texts):
        for w in range(0, len(t) - length + 1, SLICE):
            e = min(w + SLICE, len(t) - length + 1)
            a = max(0, w - reach)
            pieces.append((i, a, t[a: e + length + reach], w - a, e - a))
    out, held, size = [], [], 0
    for piece in [*pieces, None]:
        if held and (piece is None or size + len(piece[2]) > SLICE):
            base = np.cumsum([0, *(len(p[2]) for p in held)])
            at, h = anchors(np.frombuffer(b"".join(p[2] for p in held), np.uint8),
                            [(b + p[3], b + p[4]) for b, p in zip(base.tolist(), held)], length)
            which = np.searchsorted(base, at, side="right") - 1
            low, high = np.maximum(at - reach, base[which]), np.minimum(at + length, base[which + 1])
            context = _mix(h.of(low, high) + _mix(((at - low) * 1000 + high - low).astype(np.uint64)))
            first = np.array([p[1] for p in held])[which]
            out.append((np.array([p[0] for p in held])[which], at - base[which] + first, h.of(at, at + GRAM), context))
            held, size = [], 0
        if piece is not None:
            held.append(piece)
            size += len(piece[2])
    if not out:
        return [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)] * 2
    number, place, gram, context = (np.concatenate(c) for c in zip(*out))
    by = np.lexsort((place, number))
    number, place, gram, context = number[by], place[by], gram[by], context[by]
    keep = np.concatenate([[True], (number[1:] != number[:-1]) | (place[1:] != place[:-1])])  # pieces overlap
    return [number[keep], place[keep], gram[keep], context[keep]]


def _sorted(key: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """The stable order of keys, and the keys in it. Where a key and its place
    (of ``place`` bits) fit into one number, those are sorted instead."""
    if int(key.max()).bit_length() + place > 63:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = key << place
    both |= np.arange(len(key))
    both.sort()
    return both & ((1 << place) - 1), both >> place


class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of a collection of strings, each
    closed by an end mark. ``sample`` has the text positions at the runs' ends;
    ``groups`` numbers the sorted suffixes by their first ``length`` bytes
    through the places where a new group begins."""

    def __init__(self, strings: list[bytes], length: int):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        ends = self.starts + self.lengths
        text[ends] = 0
        n = len(text)
        left = np.repeat(ends, self.lengths + 1) - np.arange(n)  # bytes before the end mark
        order, halves = self._suffixes(text, left, length)
        before = text[order - 1]  # a string's first byte follows an end mark, the first of all the last one
        head = np.flatnonzero(np.concatenate([[True], before[1:] != before[:-1]]))
        self.n, self.run_start, self.run_byte = n, head, before[head]
        self.sample = order[np.append(head[1:], n) - 1]
        size = np.diff(np.append(head, n))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=257))])  # of the suffixes by first byte
        by_byte = np.argsort(self.run_byte.astype(np.uint16), kind="stable")
        # where a run's first row goes: after the rows of smaller bytes and of that byte's earlier runs
        rank = np.cumsum(size[by_byte]) - size[by_byte]
        self.run_goes = np.empty(len(head), np.int64)
        self.run_goes[by_byte] = rank  # end marks, as bytes before, sort first as well
        a, b = order[:-1], order[1:]
        half, far = halves
        same = (left[a] >= length) & (left[b] >= length) & (half[a] == half[b])
        at = np.flatnonzero(same)
        same[at] = half[a[at] + far] == half[b[at] + far]
        self.groups = np.flatnonzero(np.concatenate([[True], ~same]))

    @staticmethod
    def _suffixes(text: np.ndarray, left: np.ndarray, length: int):
        """Suffixes in order (to the end mark, then by place), by doubling; and
        ranks by a prefix with a step so that two of them cover ``length``."""
        n, most = len(text), int(left.max())
        code = np.cumsum(np.bincount(text, minlength=257) > 0) - 1  # the bytes that occur, close together
        width = max(1, int(code[-1]).bit_length())
        place = n.bit_length()
        have, halves = max(1, min((63 - place) // width, length)), None
        padded = np.concatenate([code[text], np.zeros(have, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(have):
            key = key << width | padded[k: k + n]
        past = np.maximum(have - 1 - left, 0) * width  # bits after the end mark
        key = key >> past << past
        while True:
            order, s = _sorted(key, place)
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
            if halves is None and have * 2 >= length:
                halves = rank, length - have
            if have >= most:
                return order, halves if halves is not None else (rank, 0)
            key = rank << int(rank.max() + 1).bit_length()
            key[:-have] += np.where(left[:-have] >= have, rank[have:] + 1, 0)
            have *= 2

    def step(self, rows: np.ndarray) -> np.ndarray:
        """The rows of the suffixes that begin one byte earlier."""
        run = np.searchsorted(self.run_start, rows, side="right") - 1
        return self.run_goes[run] + rows - self.run_start[run]

    def count(self, pattern: bytes) -> int:
        return max(0, np.subtract(*self._search(pattern)[1::-1]))

    def _search(self, pattern: bytes) -> tuple[int, int, int]:
        """Rows of the suffixes that begin with the pattern, and the text
        position of the last one (kept by the sampled run ends)."""
        a, b, place = 0, self.n, int(self.sample[-1])
        for c in reversed(pattern):
            run_a = int(np.searchsorted(self.run_start, a, side="right")) - 1
            run_b = int(np.searchsorted(self.run_start, b - 1, side="right")) - 1
            runs = np.flatnonzero(self.run_byte[run_a: run_b + 1] == c + 1) + run_a
            if not len(runs):
                return 0, 0, -1
            new_a = int(self.step(np.array([max(a, int(self.run_start[runs[0]]))]))[0])
            last = int(runs[-1])
            end = b - 1 if last == run_b else int(self.run_start[last + 1]) - 1
            place = (place if last == run_b else int(self.sample[last])) - 1
            a, b = new_a, int(self.step(np.array([end]))[0]) + 1
        return a, b, place

    def locate(self, pattern: bytes) -> int:
        """The text position of one occurrence, -1 if there is none."""
        return self._search(pattern)[2] if pattern else -1

    def stream(self, length: int):
        """For all strings at once, from their ends backwards: (string number,
        offset, group of the ``length`` bytes there)."""
        rows = np.arange(len(self.lengths))  # an end mark's suffix has its string's number
        live = np.arange(len(self.lengths))
        # every row is asked for about once, so the runs' steps and the groups are laid out by row
        steps = np.repeat(self.run_goes - self.run_start, np.diff(np.append(self.run_start, self.n))) + np.arange(self.n)
        group = np.repeat(np.arange(len(self.groups)), np.diff(np.append(self.groups, self.n)))
        for t in range(1, int(self.lengths.max(initial=0)) + 1):
            on = self.lengths[live] >= t
            live, rows = live[on], steps[rows[on]]
            if t >= length:
                yield live, self.lengths[live] - t, group[rows]


def earlier_matches(strings: list[bytes], origin: np.ndarray, length: int) -> list[np.ndarray]:
    """Per string the offsets at which its ``length`` bytes also start earlier;
    ``origin`` orders the strings' first bytes (one apart for each byte)."""
    index = RunLengthIndex(strings, length)
    found = list(index.stream(length))
    if not found:
        return [np.empty(0, np.int64)] * len(strings)
    number, offset, group = (np.concatenate(c) for c in zip(*found))
    place = origin[number] + offset
    earliest = np.full(len(index.groups), np.iinfo(np.int64).max)
    np.minimum.at(earliest, group, place)
    late = place > earliest[group]
    number, offset = number[late], offset[late]
    by = np.lexsort((offset, number))
    return np.split(offset[by], np.cumsum(np.bincount(number, minlength=len(strings)))[:-1])


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of spans."""
    if not len(starts):
        return starts, ends
    by = np.argsort(starts, kind="stable")
    starts, far = starts[by], np.maximum.accumulate(ends[by])
    new = np.concatenate([[True], starts[1:] > far[:-1]])
    return starts[new], far[np.append(np.flatnonzero(new)[1:], len(far)) - 1]


def _bytes_of(column):
    return [v.as_buffer().to_pybytes() if v.is_valid else b"" for v in column]


def repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, tie, text, spans: documents with the spans (start, end; they may
    overlap) of strings that start earlier; null where there is none."""
    reach = length - GRAM
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = rows.withColumn("tie", F.pmod(F.xxhash64("text"), F.lit(1 << 31)))
    long_ones = rows.filter(F.octet_length("text") >= length)
    # an occurrence is (doc, at) with at = tie << 32 | place, so that it sorts as the document order does

    def find(batches):
        for batch in batches:
            docs_, ties = batch.column("doc"), batch.column("tie").to_numpy(zero_copy_only=False)
            number, place, gram, context = occurrences(_bytes_of(batch.column("text")), length)
            at = (ties[number].astype(np.int64) << 32) | place if len(number) else place
            value = docs_.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False)[number] if len(number) else place
            # of equal contexts in the batch only the first goes on; the others are covered
            by = np.lexsort((at, value, context, gram))
            gram, context, value, at, number = gram[by], context[by], value[by], at[by], number[by]
            fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])[: len(by)]
            lead = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
            covered = (value != value[lead]) | (at != at[lead])
            keep = fresh | covered
            gram = np.where(covered, _mix(_mix(value.astype(np.uint64)) + at.astype(np.uint64)), gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram[keep].view(np.int64)), pa.array(np.where(covered, 0, context.view(np.int64))[keep]),
                 docs_.take(pa.array(number[keep])), pa.array(at[keep]), pa.array(covered[keep])], ["gram", "context", "doc", "at", "covered"])

    found = long_ones.mapInArrow(find, "gram long, context long, doc long, at long, covered boolean").repartition("gram")
    same = W.partitionBy("gram", "context").orderBy("doc", "at")
    found = found.withColumn("first", F.first(F.struct("doc", "at")).over(same))
    later = ~(F.col("first.doc").eqNullSafe(F.col("doc")) & (F.col("first.at") == F.col("at")))
    found = found.withColumn("covered", F.col("covered") | later).drop("first")
    group = W.partitionBy("gram")
    found = found.withColumns({"low": F.min(F.when(~F.col("covered"), F.col("context"))).over(group), "high": F.max(F.when(~F.col("covered"), F.col("context"))).over(group),
                               "n": F.sum((~F.col("covered")).cast("int")).over(group)})
    found = found.filter("covered or low <> high").select("doc", "at", F.when(~F.col("covered"), F.col("gram")).alias("gram"), (~F.col("covered") & (F.col("n") > HOT)).alias("hot"))
    marks = store.materialise(found, "anchors")
    del found
    store.release(docs.sparkSession)

    tie, place = F.shiftright("at", 32).alias("tie"), F.col("at").bitwiseAND((1 << 32) - 1).alias("place")
    open_ = marks.filter("gram is not null and not hot").select("doc", tie, place, "gram")
    open_ = open_.groupBy("doc", "tie").agg(F.collect_list(F.struct("place", "gram")).alias("held"))

    def cut(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                text, held = batch.column("text")[r].as_buffer().to_pybytes(), batch.column("held")[r].as_py()
                low = [max(0, h["place"] - reach) for h in held]
                m = len(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h["gram"] for h in held], pa.int64()), pa.array([batch.column("doc")[r].as_py()] * m, pa.int64()),
                     pa.array([batch.column("tie")[r].as_py()] * m, pa.int64()), pa.array(low, pa.int64()),
                     pa.array([text[a: h["place"] + length] for a, h in zip(low, held)], pa.binary())], ["gram", "doc", "tie", "low", "bytes"])

    def index(batches):
        held, size, last = [], 0, None

        def spans():
            docs_, inverse = np.unique([(-1 << 63 if d is None else d, t) for _, d, t, _, _ in held], axis=0, return_inverse=True)
            origin = (inverse.reshape(-1).astype(np.int64) << 32) + np.array([x[3] for x in held])
            out = []
            for x, at in zip(held, earlier_matches([x[4] for x in held], origin, length)):
                starts, ends = _merged(at + x[3], at + x[3] + length)
                out += [(x[1], x[2], a, b) for a, b in zip(starts.tolist(), ends.tolist())]
            cols = list(zip(*out)) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc", "tie", "start", "end"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("gram", "doc", "tie", "low", "bytes"))):
                if size >= BLOCK and row[0] != last:
                    yield spans()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
                last = row[0]
        if held:
            yield spans()

    on = lambda a, b: a["doc"].eqNullSafe(b["doc"]) & (a["tie"] == b["tie"])
    contexts = rows.join(open_, on(rows, open_)).select(rows["doc"], rows["tie"], "text", "held").mapInArrow(
        cut, "gram long, doc long, tie long, low long, bytes binary")
    partial = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(index, "doc long, tie long, start long, end long")
    start = F.greatest(F.col("place") - reach, F.lit(0))
    whole = marks.filter("gram is null").select("doc", tie, place).select("doc", "tie", start.alias("start"), (F.col("place") + length).alias("end"))
    parts = whole.unionByName(partial)
    if not marks.filter("hot").isEmpty():
        parts = parts.unionByName(_hot_strings(rows, marks.filter("hot").select("doc", tie, place), on, length))
    spans = store.materialise(parts.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "spans")
    store.release(docs.sparkSession)
    return rows.join(spans, on(rows, spans), "left").select(rows["doc"], rows["tie"], "text", "spans")


def _hot_strings(rows: DataFrame, hot: DataFrame, on, length: int) -> DataFrame:
    """Spans of the strings around hot anchors that start earlier, each string
    grouped by its own hash."""
    reach = length - GRAM

    def strings(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                data = np.frombuffer(batch.column("text")[r].as_buffer(), np.uint8)
                places = np.array(batch.column("held")[r].as_py(), np.int64)
                starts = np.unique((places[:, None] - np.arange(reach + 1)).ravel())
                starts = starts[(starts >= 0) & (starts + length <= len(data))]
                h = _mix(Hashes(data).of(starts, starts + length)).view(np.int64)
                m = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array([batch.column("doc")[r].as_py()] * m, pa.int64()),
                     pa.array([batch.column("tie")[r].as_py()] * m, pa.int64()), pa.array(starts)], ["hash", "doc", "tie", "start"])

    held = hot.groupBy("doc", "tie").agg(F.collect_set("place").alias("held"))
    found = rows.join(held, on(rows, held)).select(rows["doc"], rows["tie"], "text", "held").dropDuplicates(["doc", "tie"]).mapInArrow(
        strings, "hash long, doc long, tie long, start long")
    least = found.groupBy("hash").agg(F.min(F.struct("doc", "tie", "start")).alias("least"))
    later = found.join(least, "hash").filter(F.struct("doc", "tie", "start") > F.col("least"))
    return later.select("doc", "tie", "start", (F.col("start") + length).alias("end"))


def removed(docs: DataFrame, length: int = 100, **columns) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes), runs
    (the removed runs)."""

    def drop(batches):
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("spans")):
                data = text.as_buffer().to_pybytes()
                held = spans.as_py() or []
                a, b = _merged(np.array([s["start"] for s in held], np.int64), np.minimum(np.array([s["end"] for s in held], np.int64), len(data)))
                edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(data)]
                kept = b"".join(data[x:y] for x, y in zip(edges[::2], edges[1::2]))
                out.append((doc, len(data), len(data) - len(kept), len(a), kept, [{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]))
            cols = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "runs"])

    return repeats(docs, length, **columns).select("doc", "text", "spans").mapInArrow(
        drop, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, runs array<struct<start:bigint,end:bigint>>")


def q_op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = removed(store.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
