"""Secret scan against Python's re, the quality classifier on held-out labels,
and the pipeline's stages."""

import hashlib
import inspect
import random
import re

import duckdb
import pandas as pd
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneltide.llm import curve_packing, queries, quality_bayes, secret_scan, store
from tests.llm.conftest import edge_rows, prose

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def odd_texts():
    r = random.Random(4)
    bits = ["password", "Secret", "TOKEN", "api_key", "apikey", "passwd", "=", ":", " ", '"', "'", "abc", "abcdefgh", "12345678", "AKIA", "AKIA0123456789ABCD",
            "0123456789abcdef" * 2, "deadbeef" * 5, "\n", "é", "\U0001f600", "x", "ſecret", "toKen", "==", "  "]
    return ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(600)] + ["secret=abcdefgh " * 900]


def test_base_spans_against_re(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(k, t, 1, 1, 1) for k, t in enumerate(texts)], "doc_id long, text string, base int, runs int, all int")
    for r in secret_scan.scan(docs).collect():
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == base_spans(texts[r["doc_id"]]), texts[r["doc_id"]]
        assert [s for s in r["all"] if s["kind"] < 3] == r["base"]


def test_query_digest(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in store.read(spark, sf, "documents").collect()}
    for r in queries.QUERIES["op7_secret_scan"](spark, sf).collect():
        spans = base_spans(texts[r["doc_id"]] or "")
        line = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))


def test_battery_tells_random_strings_from_words(spark):
    r = random.Random(6)
    alphabet = secret_scan.UPPER + secret_scan.LOWER + secret_scan.DIGITS
    keys = ["".join(r.choice(alphabet) for _ in range(n)) for n in (40, 48, 64, 80) for _ in range(25)]
    keys = [k for k in keys if re.search("[0-9]", k)]
    names = ["_".join(r.choice(["module", "version2", "release", "archive", "section", "number", "file", "table3"]) for _ in range(8)) + "_1" for _ in range(60)]
    plain = ["1234567890" * 5 + "abc", "abcabcabc123" * 5, "a1" * 30, "path/to/some/long/directory/with/names/in/it2"]
    rows = [(k, f"{prose(k, 5)} {t} end") for k, t in enumerate(keys + names + plain)]
    got = {x["doc_id"]: [s for s in x["all"] if s["kind"] == 3] for x in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert np.mean([len(got[k]) == 1 for k in range(len(keys))]) > 0.95
    assert np.mean([len(got[k]) > 0 for k in range(len(keys), len(rows))]) < 0.05
    text = rows[0][1]
    assert text[got[0][0]["start"]: got[0][0]["end"]] == keys[0]


def test_keys_after_names(spark):
    """Keys glued to a name, dashed and one-kind keys among many plain names."""
    r = random.Random(12)
    key = lambda alphabet, n: "".join(r.choice(alphabet) for _ in range(n))
    low, hexa = secret_scan.LOWER + secret_scan.DIGITS, "0123456789abcdef"
    url = secret_scan.UPPER + low + "-_"
    forms = [lambda: "sig=" + key(low, 40), lambda: "key_" + key(low, 32), lambda: "sig=" + key(hexa, 24), lambda: "aws_id-" + key(hexa, 30),
             lambda: "-".join(key(hexa, n) for n in (8, 4, 4, 4, 12)), lambda: "sig=" + key(url, 43), lambda: key(secret_scan.UPPER, 40), lambda: key(secret_scan.DIGITS, 28)]
    names = ["_".join(r.choice(["module", "version2", "release", "archive", "section", "number", "file", "table3"]) for _ in range(k)) + "_1" for k in (8, 9, 10) for _ in range(100)]
    keys = [form() for form in forms for _ in range(25)]
    rows = [(k, f"{prose(k, 5)} {t} end") for k, t in enumerate(keys + names)]
    got = {x["doc_id"]: [s for s in x["all"] if s["kind"] == 3] for x in secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ends = {k: t.index(" end") for k, t in rows}
    found = [any(s["end"] == ends[k] and s["end"] - s["start"] >= 24 for s in got[k]) for k in range(len(keys))]
    shares = [np.mean(found[25 * f: 25 * f + 25]) for f in range(len(forms))]
    plain = np.mean([len(got[k]) > 0 for k in range(len(keys), len(rows))])
    assert min(shares) > 0.85 and plain < 0.05, (shares, plain)


def test_normal_tail(spark):
    from math import erfc, sqrt

    z = [-3.0, -0.5, 0.0, 0.7, 2.5, 5.0]
    got = spark.createDataFrame([(x,) for x in z], "z double").select(secret_scan._upper_tail(F.col("z")).alias("p")).collect()
    assert all(abs(r["p"] - erfc(x / sqrt(2)) / 2) < 2e-7 for r, x in zip(got, z))


def test_running_sums(spark):
    values = [[], [5], list(range(1000))]
    rows = spark.createDataFrame([(v,) for v in values], "v array<bigint>")
    for r in rows.select("v", secret_scan.running(F.col("v"), 16).alias("s")).collect():
        assert r["s"] == [sum(r["v"][:k]) for k in range(len(r["v"]))]


def test_redaction(spark, edge, empty):
    out = secret_scan.redacted(edge)
    assert out.columns == edge.columns and out.count() == len(edge_rows())
    row = out.filter("doc_id = 11").first()
    assert row["text"] == "été ÄÖ 漢字 \U0001f600 [redacted]' x" and row["n_chars"] == len(row["text"])
    assert out.filter("doc_id = 0").first()["text"] == edge_rows()[0][1]
    assert out.filter("text is null").count() == edge.filter("text is null").count()
    assert secret_scan.redacted(empty).count() == 0 and secret_scan.scan(empty).count() == 0


def test_native_plan(spark):
    plan = secret_scan.scan(store.read(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = store.read(spark, sf, "documents"), store.read(spark, sf, "labels")
    seen = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    held = labels.filter(F.xxhash64("doc_id") % 2 != 0)
    out = quality_bayes.judged(docs, seen, F.col("source"), F.col("lang")).select("row.doc_id", "posterior")
    got = out.join(held, "doc_id").select("quality", (F.col("posterior") >= 0.5).cast("int").alias("keep")).toPandas()
    assert (got.quality == got.keep).mean() > 0.97
    assert got[got.quality == 1].keep.mean() > 0.98 and got[got.quality == 0].keep.mean() < 0.1


def test_sparse_sites_shrink(spark):
    """A site with one document stays near the mean; a bad one with many goes down."""
    rows = [(k, "big good", "a", 0.95) for k in range(300)] + [(k, "bad", "a", 0.1) for k in range(300, 500)] + [(500, "lone", "a", 0.1)]
    rows += [(k, f"h{k % 20}", "a", 0.9) for k in range(501, 900)]
    scored = spark.createDataFrame([(h, p, s) for _, h, p, s in rows], "host string, path string, p double")
    table = {r["host"]: r for r in quality_bayes.sites(scored)[0].collect()}
    assert table["bad"]["host_p"] < 0.15 and table["big good"]["host_p"] > 0.93
    assert table["lone"]["host_p"] - 0.1 > 20 * (table["bad"]["host_p"] - 0.1) > 0


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(0, 1), (3, 0), (None, 1), (8, None), (9, 1), (10, 0), (0, 0)], "doc_id long, quality int")
    for docs, want in ((edge, len(edge_rows())), (empty, 0)):
        for l in (labels, labels.filter("doc_id > 99"), labels.filter("quality = 1")):
            got = quality_bayes.judged(docs, l, F.col("source"), F.col("lang"))
            assert got.count() == want
    kept = quality_bayes.kept(edge, labels.filter("doc_id > 99"), F.col("source"), F.col("lang"))
    assert kept.columns == edge.columns and kept.count() == len(edge_rows())


def test_stages_bound_the_batches(spark):
    """Python workers get a few megabytes at a time in every stage; a smaller
    limit of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 1000).alias("t"))

    def largest(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    try:
        corpus_pipeline._begin(spark)
        assert docs.mapInArrow(largest, "n long").agg(F.max("n")).first()[0] < 6 << 20
        spark.conf.set(key, "1m")
        corpus_pipeline._begin(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_stages(spark, tmp_path):
    """Each stage on what its predecessor kept, against what it must do."""
    sf = "/root/testdata/sf0.001"
    docs = store.read(spark, sf, "documents")
    columns, held = docs.columns, [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        out = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(out)
        docs = spark.read.parquet(out)
        held.append(docs.toPandas())
        assert docs.columns == columns or name == "packing"
    start, quality, near, secrets, mixed, packed = held
    assert set(quality.doc_id) < set(start.doc_id) and set(near.doc_id) < set(quality.doc_id)
    assert set(secrets.doc_id) == set(near.doc_id) and set(mixed.doc_id) <= set(secrets.doc_id)
    assert not any(base_spans(t) for t in secrets.text)
    assert packed.groupby("sequence_id").length.sum().max() == 1024
    assert packed[packed.start == 0].groupby("doc_id").size().to_dict() == mixed.groupby("doc_id").size().to_dict()
    run = corpus_pipeline.run(spark, sf)
    assert sorted(run.select("doc_id", "start", "length", "ids_crc32").toPandas().itertuples(index=False)) == sorted(
        packed[["doc_id", "start", "length", "ids_crc32"]].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_against_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, sf).toPandas()[list(want.columns)]
    rows = lambda df: sorted((tuple(None if pd.isna(v) else v for v in r) for r in df.astype(object).to_numpy().tolist()), key=repr)
    assert rows(got) == rows(want)
    assert curve_packing.BITS * curve_packing.DIMS < 63
