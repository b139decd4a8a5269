"""Aggregate first, join after.

Reports group a large table by attributes of a dimension. Joining row by row
would shuffle every row on the dimension key and put a hot key in one task.
Here rows are first combined per key, map side included, so the join sees at
most one row per key, however hot the key is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.functions import measures


def per_key(
    rows: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column] | None = None,
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Partial aggregates per key: ``totals`` add up, ``means`` keep sum and count."""
    parts = [expr.alias(name) for name, expr in (totals or {}).items()]
    for name, column in (means or {}).items():
        parts += [F.sum(column).alias(f"{name}__sum"), F.count(column).alias(f"{name}__n")]
    return rows.groupBy(*keys).agg(*parts)


def regroup(
    partials: DataFrame,
    groups: Sequence[str],
    totals: Sequence[str] = (),
    means: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Combine partial aggregates into coarser groups."""
    combined = [F.sum(name).alias(name) for name in totals]
    combined += [
        (F.sum(f"{name}__sum") / F.nullif(F.sum(f"{name}__n"), F.lit(0))).alias(name) for name in means
    ]
    return partials.groupBy(*groups).agg(*combined, *extra)


def by_attribute(
    rows: DataFrame,
    dimension: DataFrame,
    key: str,
    attributes: Sequence[str],
    totals: Mapping[str, Column] | None = None,
    means: Mapping[str, str] | None = None,
    also_by: Sequence[str] = (),
) -> DataFrame:
    """Group ``rows`` by attributes of the dimension found under ``key``."""
    partials = per_key(rows, [key, *also_by], totals, means)
    joined = partials.join(dimension.select(key, *attributes), key)
    return regroup(joined, [*also_by, *attributes], list(totals or {}), list(means or {}))


def stream_count() -> dict[str, Column]:
    return {"stream_count": measures.row_count()}
