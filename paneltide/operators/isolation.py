"""M7: isolation forest per key (Liu, Ting and Zhou, 2008).

Every tree of a key is grown from the ``sample`` rows of the key with the
smallest hashes of (tree, row), so each row of the key can be drawn by each
tree, whatever the key's size. A row enters a tree's draw only if its hash is
under ``2 * sample / n``, which leaves about twice the rows needed (fewer than
needed has odds of 10**-34); a ranked window keeps the smallest ``sample``, in
every map task already. All trees of many keys grow together, one level at a
time; splits are hashes of (key, tree, node), so a forest doesn't depend on
partitions or on the order of rows. Rows are scored in hashed chunks joined
with their key's draws: a key is never gathered. Forests are grown where the
rows are scored, a bounded number of nodes at a time; a forest is larger than
the rows of most keys, so none is moved.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.operators.joins import broadcast_if_small

CHUNK = 4096           # rows of a key scored together, about
GROWN = 1_000_000      # tree nodes grown together, at most
_NODE = np.dtype([("feature", "<i4"), ("cut", "<f8"), ("depth", "<f8")])


def unresolved_depth(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n rows: what a leaf of n
    rows would still have grown."""
    n = np.asarray(n, float)
    safe = np.maximum(n, 2.0)
    return np.where(n <= 1, 0.0, 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe)


def uniform(key, tree, node, salt: int) -> np.ndarray:
    """A number in [0, 1) for each (key, tree, node): two rounds of a 64-bit
    multiply-and-shift hash."""
    z = np.asarray(key).astype(np.uint64) ^ np.uint64(salt)
    with np.errstate(over="ignore"):  # modulo 2**64
        for part in (tree, node):
            z = z + (np.asarray(part).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(float) / 2.0**53


def height(psi: int) -> int:
    return int(np.ceil(np.log2(max(psi, 2))))


def grow(x: np.ndarray, group: np.ndarray, keys: np.ndarray, trees: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Trees of groups 0 .. G-1 as a G x nodes table in heap order (children of
    i are 2i+1 and 2i+2). ``group`` says which tree a row of ``x`` was drawn
    for; ``keys``, ``trees`` and ``limits`` (heights) are the groups'."""
    width = 2 ** (int(limits.max()) + 1) - 1
    out = np.zeros((len(keys), width), _NODE)
    out["feature"] = -1
    order = np.argsort(group, kind="stable")
    rows, own, node = order, group[order], np.zeros(len(order), np.int64)
    for level in range(int(limits.max()) + 1):
        if not len(rows):
            break
        by = np.argsort(own * width + node, kind="stable")
        rows, own, node = rows[by], own[by], node[by]
        slot = own * width + node
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        count = np.diff(np.r_[first, len(slot)])
        g, at = own[first], node[first]
        feature = (uniform(keys[g], trees[g], at, 1) * x.shape[1]).astype(np.int64)
        spread = np.repeat(np.arange(len(first)), count)
        value = x[rows, feature[spread]]
        low, high = np.minimum.reduceat(value, first), np.maximum.reduceat(value, first)
        leaf = (count <= 1) | (low == high) | (level >= limits[g])
        cut = np.maximum(high - uniform(keys[g], trees[g], at, 2) * (high - low), np.nextafter(low, high))
        out["depth"][g[leaf], at[leaf]] = level + unresolved_depth(count[leaf])
        inner = ~leaf
        out["feature"][g[inner], at[inner]] = feature[inner]
        out["cut"][g[inner], at[inner]] = cut[inner]
        goes = inner[spread]
        right = (value >= cut[spread])[goes]
        rows, own, node = rows[goes], own[goes], 2 * node[goes] + 1 + right
    return out


def scores(x: np.ndarray, forest: np.ndarray, key: np.ndarray, psi: np.ndarray, n_trees: int) -> np.ndarray:
    """2 ** (-mean depth / unresolved_depth(psi)); all rows go down all trees of
    their key (``key`` numbers them, ``psi`` is theirs) together."""
    flat, width = forest.reshape(-1), forest.shape[1]
    base = (key[:, None] * n_trees + np.arange(n_trees)) * width
    at = np.zeros((len(x), n_trees), np.int64)
    rows = np.arange(len(x))[:, None]
    while True:
        here = base + at
        feature = flat["feature"][here]
        inner = feature >= 0
        if not inner.any():
            break
        right = x[rows, np.maximum(feature, 0)] >= flat["cut"][here]
        at = np.where(inner, 2 * at + 1 + right, at)
    depth = flat["depth"][base + at].mean(axis=1)
    return np.power(2.0, -depth / np.maximum(unresolved_depth(psi), 1e-12))


def _matrix(values: pa.Array, width: int) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0] + lengths[0] - 1, starts[1] .., joined."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _scorer(n_trees: int, width: int, sample: int):
    """Grows each key's forest next to its rows and scores them, so that no
    forest is moved or kept: as many keys at once as their trees have room."""
    def batches(stream):
        for batch in stream:
            rows, held, kh = batch.column("rows"), batch.column("held"), batch.column("kh").to_numpy()
            psi = np.minimum(batch.column("n").to_numpy(), sample)
            limits = np.array([height(p) for p in psi.tolist()])
            ks = batch.column("k").to_pylist()
            drawn = held.is_valid().to_numpy(zero_copy_only=False)
            fresh = np.array([r == 0 or not drawn[r] or ks[r] != ks[r - 1] for r in range(len(ks))])  # chunks of a key share its forest
            size, draws_ = (c.value_lengths().fill_null(0).to_numpy().astype(np.int64) for c in (rows, held))
            begin, draw = np.cumsum(size) - size, np.cumsum(draws_) - draws_
            rows, held = rows.flatten(), held.flatten()
            x, hx = _matrix(rows.field("x"), width), _matrix(held.field("x"), width)
            tree = held.field("tree").to_numpy(zero_copy_only=False)
            at = 0
            while at < len(ks):
                to, high, grown = at + 1, limits[at], 1
                while to < len(ks) and (grown + fresh[to]) * n_trees * 2 ** (max(high, limits[to]) + 1) <= GROWN:
                    high, grown, to = max(high, limits[to]), grown + fresh[to], to + 1
                lead = np.flatnonzero(np.concatenate([[True], fresh[at + 1:to]])) + at  # a forest's first row here
                number = np.cumsum(np.concatenate([[0], fresh[at + 1:to]]))
                small, large = np.flatnonzero(~drawn[lead]), np.flatnonzero(drawn[lead])
                every, some = _spans(begin[lead[small]], size[lead[small]]), _spans(draw[lead[large]], draws_[lead[large]])
                # a small key's rows serve all of its trees, as do draws for tree -1
                px, pt = np.concatenate([x[every], hx[some]]), np.concatenate([np.full(len(every), -1), tree[some]])
                key = np.concatenate([np.repeat(small, size[lead[small]]), np.repeat(large, draws_[lead[large]])])
                all_, one = np.flatnonzero(pt < 0), np.flatnonzero(pt >= 0)
                px = np.concatenate([px[one], np.repeat(px[all_], n_trees, axis=0)])
                key, pt = np.concatenate([key[one], np.repeat(key[all_], n_trees)]), np.concatenate([pt[one], np.tile(np.arange(n_trees), len(all_))])
                groups = np.arange(len(lead) * n_trees)
                forest = grow(px, key * n_trees + pt, kh[lead][groups // n_trees], groups % n_trees, limits[lead][groups // n_trees])
                row = np.repeat(np.arange(at, to), size[at:to])
                first = begin[at]
                for cut in range(0, len(row), CHUNK):
                    r = row[cut:cut + CHUNK]
                    part = slice(first + cut, first + cut + len(r))
                    s = scores(x[part], forest, number[r - at], psi[r], n_trees)
                    copies = np.repeat(np.arange(len(s)), rows.field("m").to_numpy()[part])
                    for out in range(0, len(copies), CHUNK):  # repeated rows go out in parts
                        some = copies[out:out + CHUNK]
                        yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(r[some])), rows.field("t").take(pa.array(first + cut + some)),
                                                          pa.array(s[some])], ["k", "t", "s"])
                at = to

    return batches


def panel_rows(df: DataFrame, key: str, t: str, feats: list[str]) -> DataFrame:
    """(k, kh, t, x, m, n, all): distinct rows with their copies, and their
    key's distinct and total rows. A missing feature reads 0."""
    x = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in feats])
    rows = df.select(F.col(key).alias("k"), F.xxhash64(key).alias("kh"), F.col(t).alias("t"), x.alias("x")).groupBy("k", "kh", "t", "x").agg(F.count("*").alias("m"))
    sizes = rows.groupBy("k").agg(F.count("*").alias("n")).withColumnRenamed("k", "sk")
    return rows.join(broadcast_if_small(sizes), F.col("k").eqNullSafe(F.col("sk"))).drop("sk")


def draws(rows: DataFrame, n_trees: int, sample: int, seed: int) -> DataFrame:
    """(k, kh, n, tree, x): the rows that each tree is grown from; ``tree`` is
    -1 where a key has at most ``sample`` rows, all of which serve every tree."""
    row = F.xxhash64("kh", "t", "x")
    hashed = lambda tree: F.xxhash64(F.lit(seed), tree, F.col("row"))
    share = lambda h: h.bitwiseAND(F.lit(2**53 - 1)).cast("double") / 2.0**53
    taken = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda tree: share(hashed(tree)) < 2.0 * sample / F.col("n"))
    every = F.when(F.col("n") <= sample, F.array(F.lit(-1))).otherwise(taken)
    drawn = rows.withColumn("row", row).select("k", "kh", "n", "t", "x", "row", F.explode(every).alias("tree"))
    order: list[Column] = [share(hashed(F.col("tree"))), F.col("row"), F.col("t")]
    rank = F.row_number().over(Window.partitionBy("k", "kh", "tree").orderBy(*order))
    return drawn.withColumn("r", rank).filter(F.col("r") <= sample).select("k", "kh", "n", "tree", "x")


def forest_scores(df: DataFrame, key: str, t: str, feats: list[str], n_trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """key, time and ``iforest_score`` of every row. Repeated rows are drawn as
    one and scored each; a null key is a key."""
    # the code goes with the task, so workers need only numpy and pyarrow
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    kind = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = panel_rows(df, key, t, feats)
    # keys of at most ``few`` rows have one chunk, which holds all that their trees are grown from
    few = min(sample, CHUNK - 1)
    drawn = draws(rows.filter(F.col("n") > few), n_trees, sample, seed)
    # at most n_trees * sample rows for a key
    held = drawn.groupBy("k").agg(F.collect_list(F.struct("tree", "x")).alias("held")).withColumnRenamed("k", "fk")
    chunk = F.pmod(F.xxhash64("t", "x"), F.floor(F.col("n") / CHUNK) + 1)
    parts = rows.groupBy("k", chunk.alias("chunk")).agg(F.first("kh").alias("kh"), F.first("n").alias("n"), F.collect_list(F.struct("t", "m", "x")).alias("rows"))
    joined = parts.join(held, F.col("k").eqNullSafe(F.col("fk")), "left").select("k", "kh", "n", "rows", "held")
    out = joined.mapInArrow(_scorer(n_trees, len(feats), sample), f"k {kind[key]}, t {kind[t]}, s double")
    return out.select(F.col("k").alias(key), F.col("t").alias(t), F.col("s").alias("iforest_score"))
