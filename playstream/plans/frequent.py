"""Most frequent values of any period, out of short lists kept per window.

A window keeps its ``size`` most frequent values with their counts, and the largest count it left out. Lists add up: of a
value that a window does not list, that window holds between none and as many as it left out. Each merged value thus
has a lower and an upper bound, and the merged list can be cut and merged again. Where nothing was left out
the counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstream.functions.timeparts import window_start

SIZE = 1024
COLUMNS = ("time_window", "place", "item", "low", "high", "rest")


def _cut(bounded: DataFrame, rest: Column, size: int) -> DataFrame:
    """The ``size`` values of the highest upper bounds. Spark keeps only as many of a window in each task before it
    sends them, so a window with very many values costs a short list per task."""
    line = Window.partitionBy("time_window").orderBy(F.desc("high"), F.desc("low"), "item")
    placed = bounded.withColumn("place", F.row_number().over(line)).where(F.col("place") <= size + 1)
    left_out = F.coalesce(F.max(F.when(F.col("place") == size + 1, F.col("high"))).over(Window.partitionBy("time_window")), F.lit(0))
    return placed.withColumn("rest", F.greatest(rest, left_out)).where(F.col("place") <= size).select(*COLUMNS)


def listed(events: DataFrame, key: str, width: str, size: int = SIZE) -> DataFrame:
    """``(time_window, place, item, low, high, rest)``: the list of each window. Events without a time or a value of ``key``
    do not count; ties go to the smaller value."""
    usable = events.where(F.col("timestamp").isNotNull() & F.col(key).isNotNull())
    counted = usable.groupBy(window_start("timestamp", width).alias("time_window"), F.col(key).alias("item")).agg(
        F.count(F.lit(1)).alias("low")
    )
    return _cut(counted.withColumn("high", F.col("low")), F.lit(0).cast("long"), size)


def _bounded(lists: DataFrame, into: Column) -> DataFrame:
    """``(time_window, item, low, high, unseen)``: bounds of each value over the windows that ``into`` puts together;
    ``unseen`` is the upper bound of values that no list has."""
    sited = lists.withColumn("time_window", into)
    unseen = sited.where("place = 1").groupBy("time_window").agg(F.sum("rest").alias("unseen"))
    sums = [F.sum(c).alias(c) for c in ("low", "high", "rest")]
    added = sited.groupBy("time_window", "item").agg(*sums).join(unseen, "time_window")
    return added.select("time_window", "item", "low", (F.col("high") + F.col("unseen") - F.col("rest")).alias("high"), "unseen")


def merged(lists: DataFrame, width: str, size: int = SIZE) -> DataFrame:
    """Lists of wider windows, of the same form."""
    return _cut(_bounded(lists, window_start("time_window", width)), F.col("unseen"), size)


def top(lists: DataFrame, n: int = 10) -> DataFrame:
    """``(item, low, high, certain)``: the ``n`` values of the highest lower bounds over all given windows, ties to the
    smaller value. ``certain`` says that no value outside can have more."""
    whole = _bounded(lists, F.lit("1970-01-01").cast("timestamp_ntz"))
    best = whole.orderBy(F.desc("low"), "item").limit(n)
    outside = whole.join(best.select("item"), "item", "left_anti").agg(F.max("high")).scalar()
    certain = F.col("low") >= F.greatest("unseen", F.coalesce(outside, F.lit(0)))
    return best.select("item", "low", "high", certain.alias("certain"))
