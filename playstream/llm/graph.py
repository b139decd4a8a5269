"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from playstream.llm.common import settled


def _toward_min(edges: DataFrame) -> DataFrame:
    """Every edge ``(u, v)`` with the smallest partner of ``u`` beside it; large ``u`` are combined before the shuffle
    and a join can be split by Spark, so no node's partners are gathered in one place."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u")


def _digest(edges: DataFrame) -> Row:
    """Equal for equal sets of edges."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for each node of ``edges`` (columns ``a``, ``b``; long): root is the component's smallest node.

    Alternates two steps until nothing changes: larger partners move to the smallest partner of their
    node, then smaller partners do. Every round is written to the shared folder. Nulls and loops are left out.
    """
    pairs = (
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    pairs = settled(pairs, "links")
    seen = _digest(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _toward_min(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        near = _toward_min(large)
        small = (
            near.select("u", F.col("m").alias("v"))
            .unionByName(near.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        pairs, before = settled(small, "links"), seen
        seen = _digest(pairs)
        if seen == before:
            break
    stars = pairs.groupBy("u").agg(F.min("v").alias("v"))
    roots = pairs.select("v").distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
