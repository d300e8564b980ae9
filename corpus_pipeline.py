"""The corpus pipeline: five stages applied one after the other to ``documents``.

Each stage calls one of the operators and works on all that its predecessor
kept; all but the last return the columns of documents. ``run`` writes each
stage's result to the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import curve_packing, flow_mixing, partenum_join, quality_bayes, secret_scan, store, tokens


def _begin(spark: SparkSession) -> None:
    """Each stage may be the first one that a session runs. The executors' Python
    workers serve all stages, so what one of them takes, the next ones hold."""
    store.ship(spark)
    store.bound_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    _begin(spark)
    return quality_bayes.kept(docs, store.read(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays (five words, 0.8)."""
    _begin(spark)
    return partenum_join.one_of_each(docs, percent=80, width=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    _begin(spark)
    return secret_scan.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated so that sources meet their targets."""
    _begin(spark)
    return flow_mixing.mixed(docs, flow_mixing.one_two_three)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids as pieces of packed sequences."""
    _begin(spark)
    return curve_packing.pack(docs, tokens.tokenizer_path("byte_bpe_50k.json"), end_id=0)


STAGES = [("quality classifier", quality), ("near-copy join", near_copies), ("secret scan", secrets), ("source mixing", mixing), ("packing", packing)]

#: Tokenisation and the classifier are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = store.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store.materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
