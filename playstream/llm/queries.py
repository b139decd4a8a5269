"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playstream.llm import (
    bpe,
    centroids,
    embeddings,
    gam,
    language_id,
    mixing,
    packing,
    pii,
    quality_rules,
    repeats,
    resampling,
    simhash,
    url_filter,
)
from playstream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.report(table(spark, folder, "documents"))


def op3_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return gam.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op5_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.report(table(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.languages(table(spark, folder, "documents"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pieces(table(spark, folder, "documents"))


def op12_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(table(spark, folder, "embeddings"))


REGISTERED = (
    op1_simhash_near_dedup,
    op2_repeated_passages,
    op3_bpe_round_trip,
    op4_embedding_near_dedup,
    op5_pii_pseudonyms,
    op6_quality_rules,
    op7_quality_classifier,
    op8_url_filter,
    op9_source_mixing,
    op10_language_id,
    op11_packing,
    op12_target_resampling,
    op13_centroid_clustering,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in REGISTERED}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_embedding_near_dedup": embeddings.near_duplicates_sql(),
        "op8_url_filter": url_filter.judge_sql(),
        "op9_source_mixing": mixing.report_sql(),
        "op13_centroid_clustering": centroids.clustered_sql(),
    }
