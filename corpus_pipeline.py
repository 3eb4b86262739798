"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Every stage but the last returns the columns of documents. Toxic and poor documents go, one document
of each group of near-duplicates stays (the one with the smallest id), documents that hold a passage
of the benchmark go, and what is left is encoded and decoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrain.llm import bpe_codec, decontam, quality_fm, simhash_vp, toxicity
from tallygrain.llm.common import materialise, tables
from tallygrain.llm.queries import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def no_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, *tables(spark, sf_dir, "labels"), cut=0.5)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_fm.of_quality(docs, *tables(spark, sf_dir, "labels"), cut=0.3)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_vp.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_leaks(docs, *tables(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_codec.encode(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", no_toxicity),
    ("quality", good_quality),
    ("near_duplicates", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("bpe", tokens),
]
#: SQL expresses neither the trained models nor the fingerprints; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
