"""Quality by hierarchical empirical Bayes: document, path, host, all.

A logistic classifier on text statistics gives each document's evidence, a log
likelihood ratio. The documents' probabilities, summed by host and by path in
one grouped aggregation, say how good sites are. Beta priors are fitted by
moments: hosts shrink towards the mean of all documents, paths towards their
host, the more the fewer documents they have. A document's posterior joins its
evidence with its path's posterior, from which its own share is left out.

Texts are scored twice (once for the site sums, once for the decision) instead
of being written in between. Partial aggregation folds a hot host in each task;
only the table of paths is joined back, and nothing is broadcast by hint.

The classifier is fitted on at most ``sample`` labelled rows, those with the
smallest hashes of their ids. Without labels of both classes the evidence is 0
and everything is kept.

Defined results: null texts count as empty and rows with equal ids as rows of
their own; a null host or path is a host or path of its own; labels that are
null, and the second and later labels of an id, are not used; no documents give
no rows; other columns are kept by ``kept`` and not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm import store, tokens

_KIND = np.full(256, 6)  # marks
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\t\n\v\f\r", b".,;:'\"()-?")):
    _KIND[np.frombuffer(_bytes, np.uint8)] = _k
_KIND[128:] = 7


def features(text: str) -> list[float]:
    """Shares of kinds of characters, and how words look and repeat."""
    b = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(b, minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=8) / max(len(b), 1)
    words = text.split()
    n = max(len(words), 1)
    lines = text.split("\n")
    same = sum(map(str.__eq__, words, words[1:]))
    common = counts[np.frombuffer(b"!|*#$%&<>{}=@~^_\\/+", np.uint8)].astype(float) / max(len(b), 1)
    distinct = len(set(words)) / n
    return [*kinds, *np.sqrt(kinds), np.sqrt(common.max()), *np.sqrt(common[:4]), distinct, distinct * np.log1p(n), same / n, np.sqrt(same / n),
            min(len(b) / n, 40) / 10, np.log1p(n), len(set(lines)) / len(lines), sum(map(str.isupper, words)) / n]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pa.Array) -> pa.Array:
    out = [features(t) for _, part in tokens.texts_of(texts) for t in part]
    return pa.array(out, pa.list_(pa.float64()))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> dict:
    """Logistic regression by Newton steps on standardised features."""
    mean, spread = x.mean(0), x.std(0)
    spread[spread < 1e-9] = 1.0
    z = np.column_stack([np.ones(len(x)), (x - mean) / spread])
    w = np.zeros(z.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + np.diag(keep), z.T @ (y - p) - keep * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    scaled = w[1:] / spread
    return {"bias": float(w[0] - scaled @ mean), "weights": scaled.tolist(), "prior": float(y.mean())}


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int = 20_000) -> dict | None:
    """The classifier, from a bounded sample of the labelled documents."""
    one = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.min("y").alias("y"))
    chosen = one.orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")  # at most ``sample`` ids
    got = rows.select("y", _features("t").alias("x"), F.xxhash64("id", "t").alias("k")).orderBy("k").limit(sample).collect()
    y = np.array([r["y"] for r in got], float)
    if len(y) == 0 or y.min() == y.max():
        return None
    return fit(np.array([r["x"] for r in got]), y)


def _key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))


def evidence(docs: DataFrame, model: dict | None, text_col: str, host: Column, path: Column) -> DataFrame:
    """row (the document), host, path, odds (the log likelihood ratio) and p."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), _key(host).alias("host"), _key(path).alias("path"),
                       F.col(text_col).alias("text"))
    if model is None:
        return rows.withColumns({"odds": F.lit(0.0), "p": F.lit(0.5)}).drop("text")
    base = float(np.log(model["prior"] / (1 - model["prior"])))
    score = F.aggregate(F.zip_with(_features(F.col("text")), F.array(*map(F.lit, model["weights"])), lambda a, b: a * b),
                        F.lit(model["bias"]), lambda acc, x: acc + x)
    rows = rows.withColumn("odds", F.least(F.greatest(score, F.lit(-30.0)), F.lit(30.0)) - base).drop("text")
    return rows.withColumn("p", 1 / (1 + F.exp(-(F.col("odds") + base))))


def _strength(groups: DataFrame, centre: Column) -> float:
    """Beta strength of groups (n, s) about their centres, by moments."""
    mean = F.col("s") / F.col("n")
    r = groups.agg(F.sum(F.col("n") * F.pow(mean - centre, 2)).alias("spread"), F.count("*").alias("k"), F.sum("n").alias("n"),
                   F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("n") * centre * (1 - centre)).alias("v")).first()
    if not r["n"] or r["k"] < 2 or not r["v"]:
        return 1e9
    within = r["v"] / r["n"]
    room = r["n"] - r["nn"] / r["n"]
    between = (r["spread"] - (r["k"] - 1) * within) / room if room > 0 else 0.0
    return 1e9 if between <= 0 else min(max(within / between - 1, 1e-3), 1e9)


def sites(scored: DataFrame) -> tuple[DataFrame, float]:
    """Per path: its documents, their summed probabilities, and its host's
    posterior; and the strength with which paths shrink towards hosts."""
    paths = store.materialise(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("s")), "sites")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    r = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = float(r["s"] / r["n"]) if r["n"] else 0.5
    strength = _strength(hosts, F.lit(mean))
    hosts = hosts.select("host", ((F.col("s") + strength * mean) / (F.col("n") + strength)).alias("host_p"))
    paths = paths.join(hosts, "host")
    return paths, _strength(paths, F.col("host_p"))


def judged(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", sample: int = 20_000) -> DataFrame:
    """row (the document with all its columns), odds, p, host_p, path_p and
    posterior."""
    scored = evidence(docs, train(docs, labels, id_col, text_col, label_col, sample), text_col, host, path)
    table, strength = sites(scored)
    out = scored.join(table, ["host", "path"])
    others = (F.col("s") - F.col("p") + strength * F.col("host_p")) / (F.col("n") - 1 + strength)
    out = out.withColumn("path_p", F.least(F.greatest(others, F.lit(1e-6)), F.lit(1 - 1e-6)))
    return out.withColumn("posterior", 1 / (1 + F.exp(-(F.col("odds") + F.ln(F.col("path_p") / (1 - F.col("path_p")))))))


def kept(docs: DataFrame, labels: DataFrame, host: Column, path: Column, least: float = 0.5, **more) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    return judged(docs, labels, host, path, **more).filter(F.col("posterior") >= least).select("row.*")


def q_op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = judged(docs, store.read(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return out.select("row.doc_id", F.col("odds").alias("evidence"), F.col("p").alias("document_p"), F.col("host_p").alias("host_posterior"),
                      F.col("path_p").alias("path_posterior"), "posterior", (F.col("posterior") >= 0.5).alias("keep"))
