"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from siltworks.llm import (
    bpe,
    centroids,
    decontamination,
    exact_dedup,
    language_id,
    license_scan,
    packing,
    quality_rules,
    simhash,
    suffix_dedup,
    token_blocks,
    url_filter,
    vector_codes,
)
from siltworks.llm.common import documents

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.query(documents(spark, folder))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(documents(spark, folder))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(documents(spark, folder))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.query(documents(spark, folder))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.query(documents(spark, folder), WORD_BPE)


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{folder}/pages.parquet"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.query(documents(spark, folder))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.query(documents(spark, folder))


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.query(documents(spark, folder), BYTE_BPE, end_id=0)


def op10_token_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return token_blocks.query(documents(spark, folder), WORD_BPE, end_id=2)


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.query(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.query(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.query(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_license_scan,
        op3_language_id,
        op4_quality_rules,
        op5_bpe,
        op6_url_filter,
        op7_suffix_dedup,
        op8_exact_dedup,
        op9_packing,
        op10_token_blocks,
        op11_centroids,
        op12_vector_codes,
        op13_decontamination,
    )
}

SQL = {
    "op2_license_scan": license_scan.SQL,
    "op4_quality_rules": quality_rules.SQL,
    "op7_suffix_dedup": suffix_dedup.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op11_centroids": centroids.SQL,
    "op12_vector_codes": vector_codes.SQL,
    "op13_decontamination": decontamination.SQL,
}
