"""The queries of the training-data operators, with production parameters on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygrain.llm import bpe_codec, collocations, decontam, ogg_media, quality_fm, quality_rules, sharding, simhash_vp, spelling, token_counts, token_files, toxicity, url_filter
from tallygrain.llm.common import tables

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, vocabulary("byte_bpe_50k.json"), limit=512)


def op2_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    return quality_fm.quality(docs, labels, cut=0.3)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return bpe_codec.encode_digests(docs, vocabulary("word_bpe_49k.json"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    (pages,) = tables(spark, sf_dir, "pages")
    return url_filter.verdicts(pages)


def op5_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return ogg_media.media_digests(ogg_media.stored(ogg_media.media_table(docs)))


def op6_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return sharding.shard(docs, [1.0] * 16)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return token_files.read_token_files(*token_files.write_token_files(docs, vocabulary("byte_bpe_50k.json"), end_id=2))


def op8_toxicity_nnpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = tables(spark, sf_dir, "documents", "labels")
    return toxicity.toxicity(docs, labels, cut=0.5)


def op9_simhash_vp(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return simhash_vp.near_duplicates(docs)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(*tables(spark, sf_dir, "documents", "benchmark"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(*tables(spark, sf_dir, "documents", "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return spelling.variants(docs)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    (docs,) = tables(spark, sf_dir, "documents")
    return collocations.collocations(docs)


def queries() -> dict[str, Query]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op10_decontamination": decontam.oracle(), "op12_spelling_variants": spelling.oracle(), "op13_collocations": collocations.oracle()}
