"""Keyed changelogs and insert-only loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(changes: DataFrame, key: Sequence[str] | str, order: Sequence[str] | str) -> DataFrame:
    """The newest row per key, by ``order``.

    An aggregate combines rows before the shuffle, so a key with very many
    changes costs one row per task. A window would send and sort them all in one.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranking = [order] if isinstance(order, str) else list(order)
    others = [c for c in changes.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(*ranking)).alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"newest.{c}").alias(c) for c in others])


def without_tombstones(latest: DataFrame, payload: str) -> DataFrame:
    """Drop keys whose newest message has no payload (a delete)."""
    return latest.where(F.col(payload).isNotNull())


def new_rows(incoming: DataFrame, existing: DataFrame, primary_key: Sequence[str] | str) -> DataFrame:
    """Incoming rows whose key is not stored yet; stored rows are not updated."""
    keys = [primary_key] if isinstance(primary_key, str) else list(primary_key)
    return incoming.join(existing.select(*keys), keys, "left_anti")
