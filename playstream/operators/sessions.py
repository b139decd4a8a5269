"""Listening sessions: runs of events of one user without a long silence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstream.functions.measures import row_count
from playstream.functions.timeparts import window_start


def listening_sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per session: user, start, end, plays.

    A session ends when the next event is more than the gap away. Two events in
    one gap-wide time bucket are always in the same session, so events are first
    combined per user and bucket. The window over a user then sees a number of
    rows set by the time covered, not by how much that user plays.
    """
    gap = f"{gap_minutes} minutes"
    runs = (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", window_start("timestamp", gap).alias("bucket"))
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), row_count().alias("plays"))
        .select("user_id", "first", "last", "plays")
    )
    in_time = Window.partitionBy("user_id").orderBy("first")
    silence = F.col("first") - F.lag("last").over(in_time)
    starts = F.coalesce((silence > F.expr(f"INTERVAL '{gap_minutes}' MINUTE")).cast("int"), F.lit(1))
    return (
        runs.withColumn("starts", starts)
        .withColumn("nth", F.sum("starts").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("user_id", "nth")
        .agg(F.min("first").alias("session_start"), F.max("last").alias("session_end"), F.sum("plays").alias("plays"))
        .drop("nth")
    )


def session_stream(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """The same rows from a stream with a watermark, each once no later event can lengthen its session.

    State holds one row per open session; an event that joins two of them makes them one.
    """
    silence = F.session_window("timestamp", f"{gap_minutes} minutes").alias("span")
    return (
        events.where(F.col("user_id").isNotNull())
        .groupBy(silence, "user_id")
        .agg(F.max("timestamp").alias("session_end"), row_count().alias("plays"))
        .select(F.col("span.start").alias("session_start"), "user_id", "session_end", "plays")
    )


def session_lengths(sessions: DataFrame) -> DataFrame:
    """Number and mean length of each user's sessions."""
    lasted = _microseconds("(session_end - session_start)")
    return (
        sessions.groupBy("user_id")
        .agg(row_count().alias("sessions"), F.expr(f"sum({lasted})").alias("micros"))
        .select("user_id", "sessions", F.expr("micros / sessions / 1000000").alias("avg_session_seconds"))
    )


def _microseconds(span: str) -> str:
    """Whole microseconds of a day-time interval, without a time zone."""
    return (
        f"extract(DAY FROM {span}) * 86400000000L + extract(HOUR FROM {span}) * 3600000000L"
        f" + extract(MINUTE FROM {span}) * 60000000L + CAST(extract(SECOND FROM {span}) * 1000000 AS BIGINT)"
    )


def session_duration_by_user(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    return session_lengths(listening_sessions(events, gap_minutes))
