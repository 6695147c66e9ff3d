"""Queries of this subpackage: (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can tell."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import (alignment, ann, decontam, jaccard, langid, packing, quality, sharding, substrings, tokens, toxicity,
                            urls, whitening)
from panelspark.session import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = scratch_path(spark, f"token-files-{uuid.uuid4().hex[:12]}")
    return tokens.encode_and_read(_read(spark, sf_dir, "documents"), folder, tokens.tokenizer_path("word_bpe_49k.json"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_read(spark, sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"), tokens.tokenizer_path("byte_bpe_50k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_read(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(_read(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_components(_read(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(_read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_read(spark, sf_dir, "documents"), tokens.tokenizer_path("byte_bpe_50k.json"),
                           tokens.tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_benchmark_decontamination, op3_quality_resampling, op4_toxicity, op5_language_id,
                            op6_nearest_neighbours, op7_packing, op8_url_filter, op9_substring_dedup, op10_jaccard_join,
                            op11_sharding, op12_whitening, op13_alignment)}
ORACLES: dict[str, str] = {"op2_benchmark_decontamination": decontam.ORACLE, "op8_url_filter": urls.oracle(),
                           "op9_substring_dedup": substrings.ORACLE, "op10_jaccard_join": jaccard.ORACLE,
                           "op11_sharding": sharding.ORACLE}
