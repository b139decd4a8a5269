"""Data-quality reports: row counts, orphans, reconciliation, completeness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstream import model
from playstream.functions.measures import row_count
from playstream.functions.timeparts import window_start
from playstream.operators.integrity import broken_keys


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(row_count().alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")
            for name, df in tables.items()
        ]
    )


def orphan_counts(
    events: DataFrame, dimensions: dict[str, DataFrame], references=model.STREAM_EVENTS.references
) -> DataFrame:
    """Rows whose key is set but missing from its dimension, one line per reference."""
    missing = broken_keys(events, dimensions, references).select("reference", "rows")
    # Every reference is listed, also one without orphans.
    names = ", ".join(f"'{r.column}'" for r in references)
    listed = events.sparkSession.range(1).selectExpr(f"explode(array({names})) AS reference", "0L AS rows")
    return (
        missing.unionByName(listed)
        .groupBy("reference")
        .agg(F.sum("rows").alias("count"))
        .select(F.concat(F.lit("Orphaned "), "reference").alias("issue"), "count")
    )


def _minute_number(time: str) -> Column:
    """Whole minutes since 1970 of a zone-free time."""
    return F.expr(f"datediff({time}, DATE'1970-01-01') * 1440 + hour({time}) * 60 + minute({time})")


def metrics_reconciliation(
    metrics: DataFrame, events: DataFrame, minutes: int = 5, inclusive: bool = True, n: int | None = 10
) -> DataFrame:
    """Metric rows whose count differs from a recount of the raw events.

    The recount of a window takes events from its start to ``minutes`` later,
    that end included if ``inclusive``. One-minute windows and five inclusive
    minutes therefore report rows that are not wrong; ``minutes=1`` with
    ``inclusive=False`` is the exact check.

    Joining windows with events on the user alone would pair every window with
    every event of a hot user. Here events are counted per user and minute, put
    in line with the metric rows, and each metric row adds up the minutes that
    follow it. The line is cut into stretches of hours, so that no user's rows
    have to be in one task; minutes at the start of a stretch are also given to
    the one before, which looks that far ahead.
    """
    stretch = 60 * -(-minutes // 60)
    minute = window_start("timestamp", "1 minute")
    counted = (
        events.where(F.col("user_id").isNotNull())
        .groupBy(minute.alias("at"), "user_id")
        .agg(row_count().alias("in_minute"), F.count_if(F.col("timestamp") == minute).alias("at_start"))
        .select("user_id", _minute_number("at").alias("slot"), "in_minute", "at_start")
    )
    own = F.expr(f"slot div {stretch}")
    ahead = F.when(F.col("slot") % stretch <= minutes, own - 1)
    counted = counted.withColumn("part", F.explode(F.array_compact(F.array(own, ahead))))
    claimed = (
        metrics.where(F.col("user_id").isNotNull())
        .select("user_id", _minute_number("time_window").alias("slot"), F.col("stream_count").alias("metrics_stream_count"))
        .withColumn("part", own)
    )
    line = Window.partitionBy("user_id", "part").orderBy("slot")
    recount = F.coalesce(F.sum("in_minute").over(line.rangeBetween(0, minutes - 1)), F.lit(0))
    if inclusive:
        recount += F.coalesce(F.sum("at_start").over(line.rangeBetween(minutes, minutes)), F.lit(0))
    report = (
        counted.unionByName(claimed, allowMissingColumns=True)
        .withColumn("calculated_stream_count", recount)
        .withColumn("count_difference", F.abs(F.col("metrics_stream_count") - F.col("calculated_stream_count")))
        .where((F.col("count_difference") > 0) & (F.col("calculated_stream_count") > 0))
    )
    if n is not None:
        report = report.orderBy("user_id", "slot").limit(n)
    return report.select("user_id", "metrics_stream_count", "calculated_stream_count", "count_difference")


# Dimensions covered by the completeness report, in output order.
COVERED = (
    ("users", "user_id"),
    ("songs", "song_id"),
    ("artists", "artist_id"),
    ("devices", "device_id"),
    ("locations", "location_id"),
)


def dimension_completeness(events: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One row: distinct keys in the events next to the size of each dimension."""
    seen = events.agg(*[F.count_distinct(key).alias(f"unique_{name}_in_events") for name, key in COVERED])
    columns = []
    for name, _ in COVERED:
        columns.append(F.col(f"unique_{name}_in_events"))
        columns.append(dimensions[name].agg(row_count()).scalar().alias(f"{name}_in_dimension"))
    return seen.select(*columns)
