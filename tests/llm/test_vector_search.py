"""Exact top-k and approximate neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from paneltide.llm import collision_ann, impact_topk, store

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v int, score int, shard int, block int"


def table(spark, n=700, dims=16, seed=0):
    r = np.random.default_rng(seed)
    m = r.normal(size=(n, dims))
    m[n // 2:] = m[r.integers(0, n // 2, n - n // 2)] + 0.3 * r.normal(size=(n - n // 2, dims))
    m[5] = m[6] = m[7]
    rows = [(k, [float(np.float32(x)) for x in v], 1, 1, 1, 1, 1, 1) for k, v in enumerate(m / 4)]
    odd = [(n, None), (n + 50, [1.0, None]), (n + 100, [math.nan] * dims), (n + 150, [math.inf] * dims), (None, [1.0] * dims), (n + 250, [0.0] * dims)]
    rows += [rows[3], rows[50]]  # repeated rows are rows of their own
    return spark.createDataFrame(rows + [(i, v, 1, 1, 1, 1, 1, 1) for i, v in odd], SCHEMA), rows, n + 250


def brute(ids, m, score, k=5):
    out = []
    for i in np.flatnonzero(ids % 50 == 0):
        s = score(m, m[i])
        near = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out += [(int(ids[i]), r + 1, int(ids[j])) for r, j in enumerate(near)]
    return sorted(out)


def test_impact_topk_is_exact(spark):
    docs, rows, zero = table(spark)
    ids = np.array([r[0] for r in rows] + [zero])
    m = np.floor(256 * np.array([r[1] for r in rows] + [[0.0] * 16])).astype(np.int64)
    got = impact_topk.search(docs, F.col("id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == brute(ids, m, lambda m, q: (m * q).sum(1))
    at = {i: k for k, i in enumerate(ids.tolist())}
    assert all(r["score"] == int(m[at[r["query_id"]]] @ m[at[r["vec_id"]]]) for r in got)


def test_proof_stops_early_and_right():
    r = np.random.default_rng(1)
    m = r.normal(size=(3000, 8))
    m[:20] += 6
    ids = np.arange(3000)
    import pickle

    index = pickle.loads(impact_topk.build(ids, m, 64))
    for q in range(0, 40):
        v = np.floor(m[q] * 64).astype(np.int64)
        s = (np.floor(m * 64).astype(np.int64) * v).sum(1)
        want = [j for j in np.lexsort((ids, -s)) if j != q][:5]
        assert impact_topk.top(index, q, v, 5)[0].tolist() == want


def test_several_shards_and_blocks(spark):
    docs, rows, zero = table(spark, 400)
    from paneltide.llm import vector_blocks

    part = vector_blocks.search(vector_blocks.vectors(docs, "vec_id", "embedding"), F.col("id") % 50 == 0, 5, lambda i, m: impact_topk.build(i, m, 256.0),
                                lambda d, i, m, k: impact_topk.find(d, i, m, k, 256.0), "long", shard_rows=60, query_rows=3)
    assert set(map(tuple, part.collect())) == set(map(tuple, impact_topk.search(docs, F.col("id") % 50 == 0).collect()))


def test_collision_ann_recall(spark):
    docs, rows, _ = table(spark, 2000, 24)
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    cosine = lambda m, q: (m * q).sum(1) / np.sqrt((m * m).sum(1) * (q * q).sum())
    want = [(q, v) for q, _, v in brute(ids, m, cosine)]
    got = collision_ann.search(docs, F.col("id") % 50 == 0).collect()
    assert len(got) == len(want) and sum((r["query_id"], r["vec_id"]) in want for r in got) >= 0.9 * len(want)
    assert all(abs(r["score"] - cosine(m[r["vec_id"]][None], m[r["query_id"]])[0]) < 1e-12 for r in got)
    for q in {r["query_id"] for r in got}:
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == sorted([1, 2, 3, 4, 5] * (ids == q).sum())
        assert [(-r["score"], r["vec_id"]) for r in mine] == sorted((-r["score"], r["vec_id"]) for r in mine)


def test_collision_ann_recall_on_the_table(spark):
    docs = store.read(spark, "/root/testdata/sf0.1", "embeddings")
    rows = docs.select("vec_id", "embedding").collect()
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    want = {(q, v) for q, _, v in brute(ids, m, lambda m, q: (m * q).sum(1) / np.sqrt((m * m).sum(1) * (q * q).sum()))}
    got = collision_ann.search(docs, F.col("id") % 50 == 0).collect()
    assert sum((r["query_id"], r["vec_id"]) in want for r in got) >= 0.9 * len(want)


def test_few_or_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (50, [1.0, 1.0]), (7, [0.5])], "vec_id long, embedding array<double>")
    none = few.filter("vec_id > 99")
    for search in (impact_topk.search, collision_ann.search):
        got = search(few, F.col("id") % 50 == 0).collect()
        assert sorted((r["query_id"], r["rank"]) for r in got) == [(0, 1), (0, 2), (50, 1), (50, 2)]
        assert search(none, F.col("id") % 50 == 0).count() == 0


def test_repeated_ids_are_candidates(spark):
    """Each row but the query's own, also where ids or whole rows repeat."""
    rows = [(0, [1.0, 0.0]), (7, [1.0, 0.1]), (7, [5.0, 5.0]), (7, [5.0, 5.0]), (0, [2.0, 0.0]), (0, [1.0, 0.0]), (9, [0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = impact_topk.search(table, F.col("id") % 50 == 0, k=3).collect()
    m = np.floor(256 * np.array([v for _, v in rows])).astype(int)
    want = []
    for i, (own, _) in enumerate(rows):
        if own % 50 == 0:
            order = sorted((j for j in range(len(rows)) if j != i), key=lambda j: (-(m[j] @ m[i]), rows[j][0]))[:3]
            want += [(own, r + 1, rows[j][0], int(m[j] @ m[i])) for r, j in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)
    near = collision_ann.search(table, F.col("id") % 50 == 0, k=6).collect()
    assert len(near) == 18 and sum(r["vec_id"] == 0 for r in near) == 6


def test_cosines_of_huge_and_tiny_vectors(spark):
    rows = [(0, [1e200, 1e199]), (50, [1e-170, 3e-171]), (1, [1.0, 0.0]), (2, [0.0, 1e-300]), (3, [-1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r["query_id"], r["vec_id"]): r["score"] for r in collision_ann.search(table, F.col("id") % 50 == 0).collect()}
    unit = {i: np.array(v) / max(map(abs, v)) for i, v in rows}
    cosine = lambda a, b: unit[a] @ unit[b] / np.linalg.norm(unit[a]) / np.linalg.norm(unit[b])
    assert len(got) == 8 and all(abs(s - cosine(*p)) < 1e-12 for p, s in got.items())
