"""From raw documents to token ids: five stages, each written as Parquet and read again by the next one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playstream.llm import bpe, gam, mixing, pii, simhash
from playstream.llm.common import DOCUMENT_COLUMNS, settled, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return gam.good_documents(docs, table(spark, sf_dir, "labels")).select(*DOCUMENT_COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose fingerprints hang together the document with the smallest id stays."""
    return simhash.first_of_each_group(docs).select(*DOCUMENT_COLUMNS)


def pseudonymized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become keyed pseudonyms."""
    return pii.without_personal_data(docs).select(*DOCUMENT_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mixture(docs).select(*DOCUMENT_COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, ids_sha256)`` of each row."""
    return bpe.tokenized(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_near_copies),
    ("pii_pseudonyms", pseudonymized),
    ("source_mixing", mixed),
    ("bpe_encoding", tokenized),
]

#: Trained scores, XXH64 majorities and merges have no SQL; the tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*DOCUMENT_COLUMNS)
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
