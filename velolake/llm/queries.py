"""Registered queries of the numbered operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from velolake.llm import clustering, licenses, minhash, neighbours, packing, personal_data, quality_rules, resampling, sentencepiece_codec, shards, suffix_dedup, toxicity, warc
from velolake.llm.common import table

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.digest(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.digest(table(spark, sf_dir, "embeddings"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_MODEL)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.digest(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_personal_data": op3_personal_data,
    "op4_license_scan": op4_license_scan,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_neighbours": op7_neighbours,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_minhash": op10_minhash,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": quality_rules.oracle(),
    "op11_importance_resampling": resampling.oracle(),
    "op12_centroid_clustering": clustering.oracle(),
    "op13_warc": warc.oracle(),
}
