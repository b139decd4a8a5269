"""Dashboard charts over the metric tables.

Each chart takes a metric table already limited to its period; see
``metrics.windowed_since``. Averages here are averages of window averages, and
sums of ``unique_users`` count a person once per window.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.functions.timeparts import moment
from playstream.operators.rollup import by_attribute
from playstream.plans.business import top

HOUR = timedelta(hours=1)
DAY = timedelta(hours=24)

def _streams():
    return {"total_streams": F.sum("stream_count")}


def active_users(engagement: DataFrame) -> DataFrame:
    return (
        engagement.groupBy("time_window")
        .agg(F.count_distinct("user_id").alias("active_users"))
        .orderBy("time_window")
    )


def mean_over_time(metric: DataFrame, column: str, name: str) -> DataFrame:
    return metric.groupBy("time_window").agg(F.avg(column).alias(name)).orderBy("time_window")


def mean_by_attribute(
    metric: DataFrame, dimension: DataFrame, key: str, attribute: str, column: str, name: str
) -> DataFrame:
    return by_attribute(metric, dimension, key, [attribute], means={name: column}).orderBy(F.desc(name), attribute)


def streams_by_attribute(metric: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    return by_attribute(metric, dimension, key, [attribute], _streams())


def user_hour_heatmap(engagement: DataFrame) -> DataFrame:
    return engagement.groupBy(F.hour("time_window").alias("hour_of_day"), "user_id").agg(
        F.sum("stream_count").alias("total_streams")
    )


def top_songs(content: DataFrame, songs: DataFrame, n: int = 10) -> DataFrame:
    counted = streams_by_attribute(content, songs, "song_id", "title").withColumnRenamed("title", "song_title")
    return top(counted, n, "total_streams", "song_title")


def artist_comparison(content: DataFrame, artists: DataFrame, n: int = 10) -> DataFrame:
    compared = by_attribute(
        content,
        artists,
        "artist_id",
        ["name"],
        _streams(),
        {"avg_completion_rate": "completion_rate", "avg_like_rate": "like_rate"},
    ).withColumnRenamed("name", "artist_name")
    return top(compared, n, "total_streams", "artist_name")


def device_usage_over_time(device: DataFrame, devices: DataFrame) -> DataFrame:
    return by_attribute(
        device, devices, "device_id", ["device_type"], _streams(), also_by=["time_window"]
    ).orderBy("time_window", "device_type")


def unique_users_by_region(location: DataFrame, locations: DataFrame, n: int = 10) -> DataFrame:
    counted = by_attribute(
        location, locations, "location_id", ["region"], {"total_unique_users": F.sum("unique_users")}
    )
    return top(counted, n, "total_unique_users", "region")


def top_city_streams(location: DataFrame, locations: DataFrame, n: int = 5) -> DataFrame:
    """Streams per window for the busiest cities of the period.

    The list of cities is a limit of ``n`` rows, so broadcasting it is safe.
    """
    per_window = by_attribute(
        location, locations, "location_id", ["city"], _streams(), also_by=["time_window"]
    )
    busiest = (
        per_window.groupBy("city").agg(F.sum("total_streams").alias("all")).orderBy(F.desc("all"), "city").limit(n)
    )
    return per_window.join(F.broadcast(busiest.select("city")), "city", "left_semi").select(
        "time_window", "city", "total_streams"
    ).orderBy("time_window", "city")


def hourly_columns(hourly: DataFrame, *columns: str) -> DataFrame:
    return hourly.select("time_window", *columns).orderBy("time_window")


def listen_time_by_hour(hourly: DataFrame) -> DataFrame:
    return (
        hourly.groupBy(F.hour("time_window").alias("hour_of_day"))
        .agg(F.avg("avg_listen_time").alias("average_listen_time"))
        .orderBy("hour_of_day")
    )


def recent_engagement(engagement: DataFrame, end: datetime, minutes: int = 5) -> DataFrame:
    """Windows from ``end - minutes`` to ``end``, both included."""
    start = end - timedelta(minutes=minutes)
    return (
        engagement.where(F.col("time_window").between(moment(start), moment(end)))
        .groupBy("time_window")
        .agg(
            F.sum("stream_count").alias("stream_count"),
            F.avg("skip_rate").alias("skip_rate"),
            F.avg("like_rate").alias("like_rate"),
        )
        .orderBy("time_window")
    )
