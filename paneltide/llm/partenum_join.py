"""Jaccard join of word n-gram sets by PartEnum signatures.

Sizes are parted into bands so wide that a linked pair lies in one band or in
neighbours; a set signs for its band and the next. Within a band a linked pair
differs in at most ``k`` elements. The feature domain (hashed shingles) is cut
into ``n1`` parts of ``n2`` pieces; of the parts at least one differs in at
most ``k2`` elements, so of its pieces some ``n2 - k2`` are equal: every choice
of pieces of every part is a signature, and linked sets share one.

For large ``k`` each part is one piece and there are ``m`` parts more than
needed. Then more than ``m`` parts of a linked pair agree, so a set with at
most ``m`` empty parts need not sign for them: equal emptiness, which says
little, isn't a signature but for the few sets that have more empty parts.

Signatures travel packed, by their first bits. As more than ``m`` parts agree,
linked sets share more than ``m`` signatures less their empty parts: a set that
shares fewer with all others together links with nothing and goes, and the
others leave the largest of their groups, which common shingles make, as far as
they can't miss a linked set by it.

Sets that are equal count once. Each group of one signature takes a pivot, and
groups that overlap mostly the same one, so that a set meets few pivots: its
star. A star's sets are kept as differences from the pivot, which are short for
near copies and from which the distance of any two of them follows exactly. In
a star nothing is paired in full: the set nearest to the pivot links with all
that lie near enough whatever their differences are, and only for the others
are shared elements of the differences counted, of candidates that share a rare
one. A star beyond ``BLOCK`` sets or ``BLOCK_BYTES`` of hashes is split into
blocks by hash, and blocks are compared two by two; a task returns a forest of its links. Sets that share a
signature share a star, so no link between components is lost. Shingles are
hashed to 64 bits.

Defined results: a text without words has an empty set, linked with nothing;
rows with equal ids share a component only if their sets link; null ids are
kept and never name a component; no documents give no rows; columns other than
id and text are not read.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paneltide.llm import store
from paneltide.llm.components import components

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BLOCK = 4096  # sets of a star's block, about; two blocks are compared in one task
BLOCK_BYTES = 8 * 1024 * 1024  # hashed shingles of a block, about
ENTRIES = 500_000  # signatures packed, or grouped, at a time, about
ENTRY = 14  # bytes of one: 40 bits of the signature, the set's id, its need
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of all texts in order, and each text's count.
    Words are runs without ASCII white space, A to Z lowered."""
    data = np.frombuffer(b"\n".join(t.lower() for t in texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    start = np.flatnonzero(~space & before)
    if not len(start):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    stop = np.flatnonzero(space & ~before)
    length = stop - start
    offset = np.cumsum(length) - length
    letters = _BYTE[data[~space]]
    place = np.arange(len(letters)) - np.repeat(offset, length)
    power = np.cumprod(np.full(int(length.max()), _STEP))
    sums = np.add.reduceat(letters * power[place], offset)
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, ends)]))
    return _mix(sums + length.astype(np.uint64)), counts


def shingle_sets(texts: list[bytes], width: int = 4) -> list[np.ndarray]:
    """Each text's distinct shingle hashes, sorted."""
    words, counts = word_hashes(texts)
    n = max(len(words) - width + 1, 0)
    grams = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            grams = grams * _STEP + words[k: k + n]
    grams = _mix(grams)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            g = np.sort(grams[at: at + c - width + 1])
            out.append(g[np.concatenate([[True], g[1:] != g[:-1]])])
        elif c:
            h = np.zeros(1, np.uint64)
            for w in words[at: at + c]:
                h = h * _STEP + w
            out.append(_mix(h + np.uint64(c)))  # c words are no shingle of width words
        else:
            out.append(np.empty(0, np.uint64))
        at += c
    return out


@lru_cache(maxsize=None)
def bands(percent: int, upto: int) -> tuple[tuple[int, int], ...]:
    """(least, largest) size of each band, up to the one that holds ``upto`` and the next."""
    out, least = [], 1
    while len(out) < 2 or out[-2][1] < upto:
        out.append((least, least * 100 // percent))
        least = out[-1][1] + 1
    return tuple(out)


@lru_cache(maxsize=None)
def parameters(percent: int, least: int, largest: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, m) for sets of at least ``least`` elements whose linked
    pairs have at most ``2 * largest`` together: sizes a, b and a difference of
    d elements link when 100 (a + b - d) >= percent (a + b + d)."""
    k = 2 * largest * (100 - percent) // (100 + percent)
    if k <= 3:
        return (1, (1, 3, 5, 6)[k], k, 0)
    if k < 12:
        return (-(-(k + 1) // 3), 5, 2, 0)
    m = 0
    for _ in range(4):
        empty = (k + 1 + m) * math.exp(-least / (k + 1 + m))
        m = math.ceil(empty + 3 * math.sqrt(empty))
    return (k + 1 + m, 1, 0, m)


def signatures(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all signatures of non-empty sets."""
    return signed(sets, percent)[:2]


def signed(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set number, signature) of all signatures of non-empty sets, and how many
    of its signatures each set shares at least with any set that it links with."""
    sizes = np.array([len(s) for s in sets])
    need = np.ones(len(sizes), np.int64)
    if not len(sizes) or not sizes.max():
        return np.empty(0, np.int64), np.empty(0, np.uint64), need
    table = bands(percent, int(sizes.max()))
    band = np.searchsorted([b[1] for b in table], sizes)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    mixed = _mix(flat ^ np.uint64(0xD1B54A32D192ED03))
    nums, sigs, needs = [], [], []
    for up in (0, 1):
        inst = band + up
        shape = np.array([parameters(percent, table[max(j - 1, 0)][0], table[j][1]) for j in range(len(table))])[np.minimum(inst, len(table) - 1)]
        shape[sizes == 0] = 0
        cells = shape[:, 0] * shape[:, 1]
        base = np.cumsum(cells) - cells
        cell = base[owner] + (flat % cells[owner].astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(cells.sum()), np.uint64)
        np.add.at(sums, cell, mixed)
        filled = np.bincount(cell, minlength=len(sums)) > 0
        seed = _mix(inst.astype(np.uint64) + np.uint64(77))
        # one piece to a part
        plain = shape[:, 2] == 0
        own = np.repeat(np.arange(len(sets)), cells)
        empty = np.bincount(own, weights=~filled, minlength=len(sets))
        signs = plain[own] & (filled | (empty > shape[:, 3])[own])
        # more than m parts agree, and no more of them are empty than the set has
        needs.append(np.where(plain, np.maximum(shape[:, 3] + 1 - empty.astype(np.int64), 1), need))
        at = np.flatnonzero(signs)
        nums.append(own[at])
        sigs.append(_mix(sums[at] + _mix(seed[own[at]] + (at - base[own[at]]).astype(np.uint64))))
        # several pieces: every choice of n2 - k2 of them
        for n2, k2 in {tuple(x) for x in shape[:, 1:3].tolist() if x[1]}:
            who = np.flatnonzero((shape[:, 1] == n2) & (shape[:, 2] == k2))
            parts = shape[who, 0]
            num = np.repeat(who, parts)
            part = np.arange(len(num)) - np.repeat(np.cumsum(parts) - parts, parts)
            first = base[num] + part * n2
            for c, chosen in enumerate(itertools.combinations(range(n2), n2 - k2)):
                total = np.zeros(len(num), np.uint64)
                for q in chosen:
                    total = _mix(total + sums[first + q])
                nums.append(num)
                sigs.append(_mix(total + _mix(seed[num] + part.astype(np.uint64) * np.uint64(1 << 20) + np.uint64(c + (n2 << 8)))))
    return np.concatenate(nums), np.concatenate(sigs), np.minimum(*needs)


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each set; equal sets have equal ones."""
    return np.array([int(_mix(np.array([np.add.reduce(_mix(s ^ _STEP), dtype=np.uint64) + np.uint64(len(s))]))[0]) for s in sets], np.uint64).view(np.int64)


def _slices(batch, most: int = 1_000_000):
    """Rows of a batch, about ``most`` bytes of text at a time."""
    held, size, first = [], 0, 0
    for i, v in enumerate(batch.column("t")):
        held.append(v.as_buffer().to_pybytes() if v.is_valid else b"")
        size += len(held[-1])
        if size >= most:
            yield first, held
            held, size, first = [], 0, i + 1
    if held:
        yield first, held


def _packed(sigs: np.ndarray, ids: np.ndarray, need: np.ndarray) -> pa.RecordBatch:
    """(bucket, entries): signatures by their first 12 bits. An entry is 40 more
    bits, the set's id and its need, up to 255, so the room it takes on its way
    doesn't depend on how many partitions there are."""
    key = sigs >> np.uint64(12)
    bucket = (key >> np.uint64(40)).astype(np.uint16)
    entries = np.empty((len(key), ENTRY), np.uint8)
    entries[:, :5] = key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
    entries[:, 5:13] = ids.astype("<i8").view(np.uint8).reshape(-1, 8)
    entries[:, 13] = np.minimum(need, 255)
    entries = entries[np.argsort(bucket, kind="stable")]
    count = np.bincount(bucket, minlength=1 << 12)
    used = np.flatnonzero(count)
    ends = np.concatenate([[0], np.cumsum(count[used])]).astype(np.int32) * np.int32(ENTRY)
    blobs = pa.BinaryArray.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(ends), pa.py_buffer(entries)])
    return pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), blobs], ["bucket", "entries"])


def _met(batches):
    """(grp, set_id, weight, need) of entries sorted by bucket. Sets that share a
    signature are one group; signatures with the same members are the same
    group, which weighs as many."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        bucket = batch.column("bucket").to_numpy()
        blobs = batch.column("entries")
        ends = np.frombuffer(blobs.buffers()[1], np.int64 if pa.types.is_large_binary(blobs.type) else np.int32)[blobs.offset: blobs.offset + len(blobs) + 1]
        data = np.frombuffer(blobs.buffers()[2], np.uint8)
        cuts = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        for first, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if bucket[first] != last and size >= ENTRIES:
                yield from _grouped(held)
                held, size = [], 0
            last = bucket[first]
            rows = data[ends[first]: ends[end]].reshape(-1, ENTRY).copy()  # the batch goes
            held.append((np.full(len(rows), last, np.uint64), rows))
            size += len(rows)
    if held:
        yield from _grouped(held)


def _grouped(held: list[tuple[np.ndarray, np.ndarray]]):
    bucket, rows = (np.concatenate(x) for x in zip(*held))
    low = np.zeros((len(rows), 8), np.uint8)
    low[:, :5] = rows[:, :5]
    key = (bucket << np.uint64(40)) | low.view("<u8").ravel()
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    key, rows = key[shared], rows[order[shared]]
    ids = np.ascontiguousarray(rows[:, 5:13]).view("<i8").ravel()
    order = np.lexsort((ids, key))
    key, ids, need = key[order], ids[order], rows[order, 13]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ids[1:] != ids[:-1])  # copies in other batches
    key, ids, need = key[new], ids[new], need[new]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    sets = np.diff(np.append(begin, len(key)))
    begin, sets = begin[sets > 1], sets[sets > 1]
    if not len(begin):
        return
    at = _ranges(begin, begin + sets)
    sums = np.add.reduceat(_mix(ids[at].view(np.uint64) ^ _STEP), np.cumsum(sets) - sets)
    grp, first, weight = np.unique(_mix(sums + sets.astype(np.uint64)), return_index=True, return_counts=True)
    begin, sets = begin[first], sets[first]
    at = _ranges(begin, begin + sets)
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(grp, sets).view(np.int64)), pa.array(ids[at]), pa.array(np.repeat(weight, sets).astype(np.int64)),
                                      pa.array(need[at].astype(np.int32))], ["grp", "set_id", "weight", "need"])


def _smallest(doc_id: str, *more: str):
    """The least (id, more) of a group, null ids after all others."""
    return F.min(F.struct(F.col(doc_id).isNull().alias("void"), doc_id, *more))


def _text_key(doc_id: str):
    """Columns that name an id, null included, in a join by equality."""
    return F.coalesce(F.col(doc_id), F.lit(0)).alias("of"), F.col(doc_id).isNull().alias("void")


def classes(docs: DataFrame, percent: int, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, tie (a hash of the text), n_shingles, set_id;
    components: node, label of set ids). Documents of one class have the same label, or set id without one."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("t"))
    rows = rows.withColumn("tie", F.xxhash64("t"))

    def sized(batches):
        for batch in batches:
            for first, texts in _slices(batch):
                sets = shingle_sets(texts, width)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, len(sets)), batch.column("tie").slice(first, len(sets)),
                                                  pa.array([len(s) for s in sets], pa.int64()), pa.array(set_ids(sets))], ["doc_id", "tie", "n_shingles", "set_id"])

    def signing(batches):
        held, size = [], 0
        for batch in batches:
            for _, texts in _slices(batch):
                sets = shingle_sets(texts, width)
                ids, first = np.unique(set_ids(sets), return_index=True)  # copies in a batch sign once
                nums, sigs, need = signed([sets[i] for i in first.tolist()], percent)
                held.append((sigs, ids[nums], need[nums]))
                size += len(nums)
                if size >= ENTRIES:
                    yield _packed(*map(np.concatenate, zip(*held)))
                    held, size = [], 0
        if size:
            yield _packed(*map(np.concatenate, zip(*held)))

    spark = docs.sparkSession
    documents = store.materialise(rows.mapInArrow(sized, "doc_id long, tie long, n_shingles long, set_id long"), "sets")
    entries = rows.drop("tie").mapInArrow(signing, "bucket int, entries binary").repartition("bucket").sortWithinPartitions("bucket")
    groups = store.materialise(entries.mapInArrow(_met, "grp long, set_id long, weight long, need int").groupBy("grp", "set_id").agg(
        F.sum("weight").alias("weight"), F.max("need").alias("need")), "groups")
    del entries
    store.release(spark)
    for _ in range(2):  # without the sets that go, others share less
        groups = store.materialise(_sharing(groups), "groups")
    groups = store.materialise(_smaller(groups), "groups")
    stars = store.materialise(_stars(groups), "stars")
    members = stars.withColumn("member", F.lit(1)).unionByName(
        stars.select("pivot", F.col("pivot").alias("set_id"), F.lit(0).alias("member")).distinct())
    # a row that holds the set, also if only rows with null ids do
    firsts = documents.join(members.select("set_id").distinct(), "set_id").groupBy("set_id").agg(
        _smallest("doc_id", "tie").alias("first"), F.max("n_shingles").alias("n"))
    firsts = firsts.select("set_id", "n", *_text_key("first.doc_id"), F.col("first.tie").alias("tie"))
    members = store.materialise(members.join(firsts, "set_id"), "members")
    texts = rows.groupBy(*_text_key("id"), "tie").agg(F.first("t").alias("t"))
    links = store.materialise(_links(members, texts, percent, width), "links")
    del texts
    store.release(spark)
    return documents, components(links)


def _weighed(groups: DataFrame) -> DataFrame:
    """The groups of several sets, with their number of sets."""
    return groups.join(groups.groupBy("grp").agg(F.count("*").alias("sets")).filter("sets > 1"), "grp")


def _sharing(groups: DataFrame) -> DataFrame:
    """The groups without the sets that link with nothing, as they share fewer
    signatures with all others together than they would with a linked one."""
    rows = _weighed(groups)
    return rows.join(rows.groupBy("set_id").agg(F.sum("weight").alias("all"), F.max("need").alias("least")).filter("all >= least"), "set_id", "left_semi").select(*groups.columns)


def _smaller(groups: DataFrame) -> DataFrame:
    """The groups without the sets that need not meet there. Each set leaves the
    largest groups, as long as they stand for fewer signatures than it shares
    with a linked one. All sets take the groups in one order, so two linked
    ones stay in the smallest group they share."""
    w = W.partitionBy("set_id").orderBy(F.desc("sets"), "grp").rowsBetween(W.unboundedPreceding, 0)
    rows = _weighed(groups).withColumn("left", F.sum("weight").over(w)).filter("left >= need").select(*groups.columns)
    return rows.join(rows.groupBy("grp").count().filter("count > 1"), "grp", "left_semi")


def _stars(groups: DataFrame, steps: int = 2) -> DataFrame:
    """(pivot, set_id): each group's members meet under the group's pivot. The
    pivot is the set with the most signatures shared (then the smallest), seen
    from the group and, for each step, from the groups its members are in."""
    best = groups.groupBy("set_id").agg(F.sum("weight").alias("w")).select("set_id", F.struct((-F.col("w")).alias("w"), F.col("set_id").alias("s")).alias("best"))
    for _ in range(steps):
        grp = groups.join(best, "set_id").groupBy("grp").agg(F.min("best").alias("best"))
        best = groups.join(grp, "grp").groupBy("set_id").agg(F.min("best").alias("best"))
    grp = groups.join(best, "set_id").groupBy("grp").agg(F.min("best").alias("best"))
    return groups.join(grp, "grp").select(F.col("best.s").alias("pivot"), "set_id").distinct()


def _ranges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All whole numbers from a[k] to before b[k], for each k."""
    size = b - a
    return np.arange(size.sum()) + np.repeat(a - np.cumsum(size) + size, size)


def star_links(ids: np.ndarray, sizes: np.ndarray, deltas: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A forest of links of the sets whose differences from one pivot are
    ``deltas``. Sets x, y differ in |Ex| + |Ey| - 2 |Ex & Ey| elements and link
    when that is at most ``a`` (|x| + |y|), a = (100 - percent) / (100 +
    percent). With w = |E| - a |x| this is |Ex & Ey| >= (wx + wy) / 2.

    Whatever wx + wy <= 0 links, and then the set with the smallest w links
    with both. Any other pair has a far set; with wx <= wy and wy at least the
    smallest w of a far set, ``need`` elements at least are shared, so one of
    Ex's rarest |Ex| - need + 1 is. Those look up the candidates, whose shared
    elements are counted unless they are in one component already."""
    n, keep, more = len(ids), 100 - percent, 100 + percent
    lens = np.array([len(d) for d in deltas], np.int64)
    w = lens * more - keep * sizes  # whole numbers: w times ``more``
    label, out = np.arange(n), []
    centre = int(np.argmin(w))
    near = w + w[centre] <= 0
    for y in np.flatnonzero(near).tolist():
        if y != centre:
            out.append((int(ids[centre]), int(ids[y])))
    label[near] = centre
    if near.all() or n == 1:
        return out
    # partners of x have w from ``low`` to ``high``: more than |Ex| elements can't be shared
    low, high = np.maximum(w, w[~near].min()), 2 * more * lens - w
    need = -(-(w + low) // (2 * more))
    by_w = np.argsort(w, kind="stable")
    place = np.empty(n, np.int64)
    place[by_w] = np.arange(n)
    lo, hi = np.searchsorted(w[by_w], low), np.searchsorted(w[by_w], high, side="right")
    owner = np.repeat(np.arange(n, dtype=np.int32), lens)
    _, code, count = np.unique(np.concatenate(deltas), return_inverse=True, return_counts=True)
    # elements of one set alone are its rarest, but nobody is met there
    shared = count[code] > 1
    alone = np.bincount(owner[~shared], minlength=n)
    code, owner = code[shared], owner[shared]
    held = lens - alone
    mine = code[np.lexsort((count[code], owner))].astype(np.int32)  # each set's elements, rare ones first
    begin = np.cumsum(held) - held
    posting = np.sort(code * n + place[owner])  # (element, set in the order of w)
    del code, owner, shared
    marked = np.zeros(len(count), bool)
    for x in by_w[(low <= high)[by_w]].tolist():
        if (label[by_w[lo[x]: hi[x]]] == label[x]).all():
            continue
        own = mine[begin[x]: begin[x] + held[x]]
        rare = own[: max(lens[x] - need[x] + 1 - alone[x], 0)].astype(np.int64) * n
        met = posting[_ranges(np.searchsorted(posting, rare + lo[x]), np.searchsorted(posting, rare + hi[x]))]
        met = by_w[np.unique(met % n)]
        met = met[label[met] != label[x]]
        marked[own] = True
        for part in np.array_split(met, int(held[met].sum()) // 1_000_000 + 1):
            if len(part):
                common = np.add.reduceat(marked[mine[_ranges(begin[part], begin[part] + held[part])]], np.cumsum(held[part]) - held[part], dtype=np.int64)
                for y in part[2 * more * common >= w[x] + w[part]].tolist():
                    if label[y] != label[x]:
                        label[label == label[y]] = label[x]
                        out.append((int(ids[x]), int(ids[y])))
        marked[own] = False
    return out


def _links(members: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Links of all stars. A star's sets and its pivot travel once, as texts,
    which take less room than their hashed shingles, to the task that compares
    them; the pivot's row comes first there."""
    blocks = F.floor(F.greatest(F.count("*") / BLOCK, F.sum("n") * 8 / BLOCK_BYTES)) + 1
    rows = members.join(members.groupBy("pivot").agg(blocks.cast("int").alias("blocks")), "pivot")
    # a set of block b takes part in all pairs of blocks with b, the pivot's row in all pairs
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    b = F.pmod(F.xxhash64("set_id"), "blocks").cast("int")
    mine = F.transform(every, lambda o: F.struct(F.least(b, o).alias("i"), F.greatest(b, o).alias("j")))
    pairs = F.flatten(F.transform(every, lambda i: F.transform(F.sequence(i, F.col("blocks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    rows = rows.withColumn("at", F.explode(F.when(F.col("member") == 1, mine).otherwise(pairs)))
    rows = rows.join(texts, ["of", "void", "tie"]).select("pivot", "at.i", "at.j", "member", "set_id", "t")

    def compare(batches):
        key, centre, held = None, None, []

        def found():
            ids, sizes, deltas = zip(*held)
            links = star_links(np.array(ids), np.array(sizes), list(deltas), percent)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["u", "v"])

        for batch in batches:
            names = list(zip(*(batch.column(c).to_pylist() for c in ("pivot", "i", "j", "member", "set_id"))))
            for first, some in _slices(batch):
                for (pivot, i, j, member, set_id), x in zip(names[first: first + len(some)], shingle_sets(some, width)):
                    if (pivot, i, j) != key:
                        if len(held) > 1:
                            yield found()
                        key, centre, held = (pivot, i, j), None, []
                    if member:
                        if centre is None:
                            raise ValueError(f"the set of pivot {pivot} is missing")
                        held.append((set_id, len(x), np.setxor1d(x, centre, assume_unique=True)))
                    else:
                        centre = x
        if len(held) > 1:
            yield found()

    return rows.repartition("pivot", "i", "j").sortWithinPartitions("pivot", "i", "j", "member").mapInArrow(compare, "u long, v long")


def joined(docs: DataFrame, percent: int, width: int = 4, **columns) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest id of its class)."""
    rows = _labelled(docs, percent, width, **columns)
    least = rows.filter("n_shingles > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "label", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def _labelled(docs: DataFrame, percent: int, width: int, **columns) -> DataFrame:
    documents, label = classes(docs, percent, width, **columns)
    rows = documents.join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    return rows.select("doc_id", "tie", "n_shingles", F.coalesce("label", "set_id").alias("label"))


def one_of_each(docs: DataFrame, percent: int, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their near copies: of each class the one with the
    smallest id stays (null ids after all others; of several texts with that
    id the one with the smallest hash), of rows with that id and equal texts one."""
    rows = _labelled(docs, percent, width, id_col=id_col, text_col=text_col)
    rows = rows.groupBy("label", "doc_id", "tie", (F.col("n_shingles") > 0).alias("words")).agg(F.count("*").alias("same"))
    first = rows.filter("words").groupBy("label").agg(_smallest("doc_id", "tie", "same").alias("first")).select("first.doc_id", "first.tie", "first.same")
    first = first.unionByName(rows.filter("not words").select("doc_id", "tie", "same")).withColumnRenamed("tie", "of")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(F.col(text_col).cast("binary")).alias("tie"))
    out = rows.join(first, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("tie") == F.col("of")))
    repeated = out.filter("same > 1").dropDuplicates(["id", "tie"])
    return out.filter("same = 1").unionByName(repeated).select("row.*")


def q_op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(store.read(spark, sf_dir, "documents"), percent=85)


SQL_OP8 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, array_to_string(w[s + 1 : s + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(greatest(len(w) - 3, 1))) AS s FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
links AS (
  SELECT a.r AS a, b.r AS b
  FROM (SELECT x.r AS a, y.r AS b, count(*) AS common FROM shingles x JOIN shingles y ON x.g = y.g AND x.r <> y.r GROUP BY x.r, y.r) t
  JOIN sizes a ON a.r = t.a JOIN sizes b ON b.r = t.b
  WHERE 100 * common >= 85 * (a.n + b.n - common)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM d LEFT JOIN sizes ON sizes.r = d.r
JOIN (SELECT reach.a, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = reach.b GROUP BY reach.a) c ON c.a = d.r
"""
