"""Joins of points with intervals of any start and length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points of one key and bin that are joined in one place; more are dealt over several.
MOST = 50_000


def _seconds(time: Column | str) -> Column:
    """Whole seconds since 1970 of a zone-free time."""
    at = F.col(time) if isinstance(time, str) else time
    return F.date_diff(at.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86_400 + (
        F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    )


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    begin: str,
    end: str,
    bin_seconds: int = 3600,
    most: int = MOST,
) -> DataFrame:
    """Pairs of a point and an interval with equal ``keys`` and ``begin <= at < end``; all columns of both.

    Time is cut into bins. A point lies in one of them, an interval is put in each that it touches, so a pair meets
    exactly once, in an equality join on keys and bin. Bins with more than ``most`` points are dealt over several
    places: points by their hash, intervals to all of these. Bins should be about as wide as the intervals.
    Points without a time and empty intervals match nothing; null keys match nothing.
    """
    keys = list(keys)
    sited = points.where(F.col(at).isNotNull()).withColumn("_bin", F.floor(_seconds(at) / bin_seconds))
    counts = sited.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("n"))
    crowded = counts.where(F.col("n") > most).select(*keys, "_bin", F.ceil(F.col("n") / most).alias("_places"))
    places = F.coalesce("_places", F.lit(1))
    first, last = F.floor(_seconds(begin) / bin_seconds), F.floor(_seconds(end) / bin_seconds)
    spread = (
        intervals.where(F.col(begin) < F.col(end))
        .withColumn("_bin", F.explode(F.sequence(first, last)))
        .join(crowded, [*keys, "_bin"], "left")
        .withColumn("_place", F.explode(F.sequence(F.lit(0).cast("long"), places - 1)))
        .drop("_places")
    )
    dealt = sited.join(crowded, [*keys, "_bin"], "left").withColumn(
        "_place", F.pmod(F.xxhash64(*points.columns), places)
    )
    met = dealt.drop("_places").join(spread, [*keys, "_bin", "_place"])
    return met.where((F.col(begin) <= F.col(at)) & (F.col(at) < F.col(end))).drop("_bin", "_place")
