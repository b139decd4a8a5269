"""The five windowed metric tables, one definition for batch and stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstream.functions.measures import distinct, rate, row_count
from playstream.functions.timeparts import flatten_window, since, window_start


@dataclass(frozen=True)
class Metric:
    table: str
    width: str
    keys: tuple[str, ...]
    measures: Callable[[bool], dict[str, Column]]


def _listening() -> dict[str, Column]:
    return {
        "total_listen_time": F.sum("stream_duration_seconds"),
        "avg_listen_time": F.avg("stream_duration_seconds"),
    }


METRICS = {
    m.table: m
    for m in (
        Metric(
            "user_engagement_metrics",
            "1 minute",
            ("user_id",),
            lambda exact: {
                "stream_count": row_count(),
                **_listening(),
                "skip_rate": rate("is_skipped"),
                "like_rate": rate("is_liked"),
                "share_rate": rate("is_shared"),
                "playlist_add_rate": rate("is_added_to_playlist"),
            },
        ),
        Metric(
            "content_performance_metrics",
            "1 minute",
            ("song_id", "artist_id"),
            lambda exact: {
                "stream_count": row_count(),
                "completion_rate": rate("is_complete_play"),
                "skip_rate": rate("is_skipped"),
                "like_rate": rate("is_liked"),
            },
        ),
        Metric(
            "device_metrics",
            "1 minute",
            ("device_id",),
            lambda exact: {
                "stream_count": row_count(),
                "avg_listen_time": F.avg("stream_duration_seconds"),
                "completion_rate": rate("is_complete_play"),
            },
        ),
        Metric(
            "location_metrics",
            "1 minute",
            ("location_id",),
            lambda exact: {
                "stream_count": row_count(),
                "unique_users": distinct("user_id", exact),
                "unique_songs": distinct("song_id", exact),
            },
        ),
        Metric(
            "hourly_metrics",
            "1 hour",
            (),
            lambda exact: {
                "stream_count": row_count(),
                "unique_users": distinct("user_id", exact),
                "unique_songs": distinct("song_id", exact),
                "unique_artists": distinct("artist_id", exact),
                **_listening(),
                "skip_rate": rate("is_skipped"),
                "like_rate": rate("is_liked"),
            },
        ),
    )
}


def windowed(events: DataFrame, table: str, exact_distinct: bool = True) -> DataFrame:
    """One row per window and key. Rows without an event time have no window.

    A stream groups by the window itself, whose end the watermark closes. A batch
    groups by its start: less to shuffle, and what later joins or groups by
    ``time_window`` finds the rows partitioned already.
    """
    metric = METRICS[table]
    measured = [expr.alias(name) for name, expr in metric.measures(exact_distinct).items()]
    if events.isStreaming:
        bucket = F.window("timestamp", metric.width).alias("bucket")
        return events.groupBy(bucket, *metric.keys).agg(*measured).transform(flatten_window)
    return events.groupBy(window_start("timestamp", metric.width).alias("time_window"), *metric.keys).agg(*measured)


def windowed_since(events: DataFrame, table: str, as_of: datetime, back: timedelta) -> DataFrame:
    """Metric rows whose window starts in the period.

    Such a window holds no event before the period, so the same bound is put on
    the events, where the scan can use it.
    """
    recent = events.where(since("timestamp", as_of, back))
    return windowed(recent, table).where(since("time_window", as_of, back))
