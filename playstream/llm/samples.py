"""Bounded samples of labelled documents, for fitting models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, usable: Column | None = None) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` documents with a label of 0 or 1.

    The ids with the smallest hashes are taken, so the sample does not depend on the order of the input. An id with
    several labels gets the one that most of its rows have, 1 if they are even; one with several texts, the text
    with the least hash.
    """
    of_id = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    if usable is not None:
        of_id = of_id.where(usable)
    chosen = (
        of_id.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id")
        .limit(rows)
    )
    # at most ``rows`` pairs of numbers, so the broadcast has a fixed bound
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    return one_per_id(named, "text", "label")


def one_per_id(rows: DataFrame, *columns: str) -> DataFrame:
    """``(doc_id, *columns)`` once for each id: the row whose columns have the least hash."""
    picked = F.struct(F.xxhash64(*columns).alias("_hash"), *columns)
    return rows.groupBy("doc_id").agg(F.min(picked).alias("_row")).select("doc_id", *[f"_row.{c}" for c in columns])
