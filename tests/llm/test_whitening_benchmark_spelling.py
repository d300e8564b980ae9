"""Whitening against numpy, benchmark windows and spelling variants against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paneltide.llm import decontamination, queries, spelling_variants, whitening

from .conftest import CLASH, SCHEMA, edge_rows, prose

LOWER_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---- whitening

VECTORS = "vec_id long, embedding array<double>, label int, id int, x int, place long, part int, z int"


def numpy_whitened(vectors):
    dims = max(map(len, vectors))
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] + [100000] * (dims - len(v)) for v in vectors])
    n, s = len(x), x.sum(0)
    c = (n * x - s) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:8], u[:, ::-1][:, :8]
    return ((n * x - s) ** 2).sum(1), c @ (u / np.sqrt(e)), e / np.trace(v)


def check_whitened(got, rows):
    dev, z, share = numpy_whitened([v for _, v in rows])
    assert len(got) == len(rows) * z.shape[1]
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    key = lambda t: tuple(-1 if v is None else v for v in t)
    for k, mine in by.items():
        want = [(i, int(d), w) for (i, _), d, w in zip(rows, dev, z[:, k - 1])]
        # rows are told apart by id and deviation; the sign is that of the first clear row
        big = max(range(len(want)), key=lambda t: abs(want[t][2]))
        ours = [r for r in mine if (r["vec_id"], r["deviation"]) == want[big][:2]][0]["whitened"]
        sign = math.copysign(1, ours) * math.copysign(1, want[big][2])
        a = sorted(((r["vec_id"], r["deviation"], r["whitened"]) for r in mine), key=key)
        b = sorted(((i, d, w * sign) for i, d, w in want), key=key)
        assert [t[:2] for t in a] == [t[:2] for t in b]
        assert np.allclose([t[2] for t in a], [t[2] for t in b], atol=1e-9)
        assert all(abs(r["explained"] - share[k - 1]) < 1e-12 and r["identity_error"] < 1e-9 and r["n"] == len(rows) for r in mine)


@pytest.mark.parametrize("split", [65_536, 40])
def test_whitening_against_numpy(spark, monkeypatch, split):
    monkeypatch.setattr(whitening, "SPLIT_ROWS", split)  # the small one sums several partial products
    monkeypatch.setattr(whitening, "ROWS_PER_BLOCK", 16)
    r = np.random.default_rng(3)
    m = r.normal(size=(150, 12)) @ np.diag(np.linspace(0.1, 1.2, 12)) + 0.3
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(m)]
    rows += [(None, [0.5] * 12), (4, [0.25] * 12), (5, [1.0, 2.0]), (6, [])]
    odd = [(900, None), (901, [1.0, None]), (902, [math.nan] * 12), (903, [math.inf] * 12), (904, [1e300] * 12)]
    table = spark.createDataFrame([(i, v, 1, 1, 1, 1, 1, 1) for i, v in rows + odd], VECTORS).repartition(5)
    check_whitened(whitening.whiten(table).collect(), rows)


def test_whitening_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r[0], r[1]) for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    check_whitened(queries.QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001").collect(), rows)


def test_whitening_of_little(spark):
    table = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(table([])).collect() == []
    assert whitening.whiten(table([(1, None), (2, [None])])).collect() == []
    assert whitening.whiten(table([(1, [])])).collect() == []
    assert whitening.whiten(table([(1, [1.0, 2.0])])).collect() == []  # no variance
    assert whitening.whiten(table([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    got = whitening.whiten(table([(1, [1.0, 7.0]), (2, [3.0, 7.0])])).collect()  # one dimension varies
    assert [(r["vec_id"], r["component"], round(abs(r["whitened"]), 12)) for r in sorted(got)] == [(1, 1, 1.0), (2, 1, 1.0)]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 0.5]), (3, [0.0, 1.0])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    # row 3 lies in the middle of the large dimension: only there the sum of squares fits
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in rows]
    want = {i: sum((3 * a - sum(c)) ** 2 for a, c in zip(v, zip(*x))) for (i, _), v in zip(rows, x)}
    assert got == {i: d if d < 2**63 else None for i, d in want.items()} and got[1] is None and got[3] is not None


# ---- benchmark decontamination

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER_AZ))


def brute_hits(docs, items, window=10):
    wanted = {}
    for i, text in items:
        w = item_words(text)
        for s in range(max(len(w) - window + 1, 1) if w else 0):
            wanted.setdefault(tuple(w[s:s + window]), set()).add(i)
    out = []
    for d, text in docs:
        w, hit, held = item_words(text), set(), set()
        for n in {len(k) for k in wanted}:
            for s in range(len(w) - n + 1):
                ids = wanted.get(tuple(w[s:s + n]))
                if ids:
                    hit |= set(range(s, s + n))
                    held |= ids
        ids = sorted(str(i) for i in held if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def benchmark_items():
    passage = prose(9, 70).split()
    return [(7, " ".join(passage[:25])), (10, " ".join(passage[20:45]).upper()), (7, " ".join(passage[:25])), (2, "short"), (3, "two, WORDS!"), (4, None), (5, ""),
            (6, "..."), (None, " ".join(passage[50:62])), (8, prose(40, 30)), (9, "a b c d e"), (11, " ".join(["an"] * 14)), (12, "漢字 \U0001f600"), (13, "é")]


@pytest.mark.parametrize("shingle,block", [(3, 500_000), (2, 5), (10, 500_000), (1, 500_000)])
def test_decontamination_against_brute_force(spark, tmp_path, monkeypatch, shingle, block):
    monkeypatch.setattr(decontamination, "BLOCK", block)  # the small one takes several joins
    more = [(100, " ".join(["an"] * 40)), (101, "x " + " ".join(["an"] * 13) + " y " + " ".join(["an"] * 14)), (102, prose(40, 30) * 3), (None, prose(40, 30)), (None, prose(40, 30))]
    rows = edge_rows() + [(d, t, None, None, None, *([1] * len(CLASH))) for d, t in more]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame([(i, t, 1, 1) for i, t in benchmark_items()], "item_id long, text string, item int, w int")
    got = decontamination.decontaminate(docs, items, shingle=shingle)
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest(), r["n_hit"] > 0) for r in got.collect()]
    assert sorted(got, key=repr) == brute_hits([(r[0], r[1]) for r in rows], benchmark_items())


def test_decontamination_of_empty_tables(spark, edge, empty):
    items = spark.createDataFrame(benchmark_items(), "item_id long, text string")
    assert decontamination.decontaminate(empty, items).count() == 0
    clean = decontamination.decontaminate(edge, items.limit(0)).collect()
    assert len(clean) == len(edge_rows()) and all(r["n_hit"] == 0 and r["item_ids"] == [] for r in clean)


def test_decontamination_stays_native(spark, edge):
    plan = decontamination.decontaminate(edge, spark.createDataFrame(benchmark_items(), "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# ---- spelling variants

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts[form[w]] if form[w] else -1) for w, n in counts.items())


def as_rows(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abé\U0001f600漢", min_size=1, max_size=6), min_size=2, max_size=12, unique=True))
def test_tile_compares_like_the_definition(words):
    left, right, lengths = spelling_variants.matrices(words)
    pairs = list(itertools.combinations(range(len(words)), 2))
    near, _ = spelling_variants.compare(left, right, lengths, np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]))
    assert near.tolist() == [one_edit(words[i], words[j]) for i, j in pairs]


@pytest.mark.parametrize("block,pairs", [(1024, 1 << 19), (3, 1 << 19), (7, 5)])
def test_variants_against_brute_force(spark, monkeypatch, block, pairs):
    monkeypatch.setattr(spelling_variants, "PAIRS", pairs)
    r = random.Random(5)
    counts = {}
    for _ in range(260):
        counts["".join(r.choice("abé") for _ in range(r.randint(4, 8)))] = r.choice((2, 3, 19, 20, 21, 250, 3000, 40_000))
    words = spark.createDataFrame([(w, n) for w, n in counts.items()], "word string, n long")
    assert as_rows(spelling_variants.variants(words, block=block)) == brute_variants(counts)


def test_tiles_reach_over_arrow_batches(spark):
    r = random.Random(6)
    counts = {"".join(r.choice("ab") for _ in range(9)): 2 for _ in range(200)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling_variants.tiles(words, 40).orderBy(*spelling_variants.TILE, "block", "length", ascending=[1, 1, 1, 1, 1, 1, 0]).drop("length").toPandas()
    batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
    want = {(a, b) for a in counts for b in counts if one_edit(a, b)}
    for size in (1, 7, 10_000):
        found = [p for out in spelling_variants.near_pairs(batch.slice(k, size) for k in range(0, batch.num_rows, size)) for p in zip(*(out.column(c).to_pylist() for c in ("word", "near")))]
        assert len(found) * 2 == len(want) and {*found, *((b, a) for a, b in found)} == want


def brute_counts(rows):
    seen = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER_AZ)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def test_spelling_query_on_edge_rows(spark, tmp_path):
    rows = edge_rows() + [(d, "Éclaircissement éclaircissement colouring coloring", None, None, None, *([1] * len(CLASH))) for d in range(200, 330)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    got = as_rows(queries.QUERIES["op13_spelling_variants"](spark, str(tmp_path)))
    assert got == brute_variants(brute_counts([(r[0], r[1]) for r in rows]))
    assert any(r[1] for r in got) and any(r[2] != r[0] for r in got)


def test_no_words(spark, empty):
    assert spelling_variants.variants(spelling_variants.counted(empty)).count() == 0
