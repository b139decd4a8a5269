"""Reports beyond the standard set, each a grouped aggregate over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstream.functions.measures import flagged, percentage, rounded_quotient, row_count
from playstream.operators.rollup import by_attribute, per_key, regroup, stream_count
from playstream.plans.business import activity_by_place, top


def top_artists(events: DataFrame, artists: DataFrame, n: int = 10) -> DataFrame:
    counted = by_attribute(events, artists, "artist_id", ["name"], stream_count())
    return top(counted.withColumnRenamed("name", "artist_name"), n, "stream_count", "artist_name")


def top_genres(events: DataFrame, songs: DataFrame, n: int = 10) -> DataFrame:
    return top(by_attribute(events, songs, "song_id", ["genre"], stream_count()), n, "stream_count", "genre")


def _skips() -> dict[str, Column]:
    return {"total_streams": row_count(), "skipped_streams": flagged("is_skipped")}


def skip_rate_by(events: DataFrame, dimension: DataFrame, key: str, attribute: str) -> DataFrame:
    return by_attribute(events, dimension, key, [attribute], _skips()).withColumn(
        "skip_rate", percentage("skipped_streams", "total_streams")
    )


def user_summary(events: DataFrame, users: DataFrame) -> DataFrame:
    """Listening per user; distinct songs come from one row per (user, song)."""
    flags = {"skipped": flagged("is_skipped"), "liked": flagged("is_liked")}
    totals = stream_count() | flags | {"total_listen_time": F.sum("stream_duration_seconds")}
    played = per_key(events, ["user_id", "song_id"], totals)
    per_user = regroup(played, ["user_id"], list(totals), extra=[F.count("song_id").alias("songs_played")])
    return per_user.join(users.select("user_id", "username"), "user_id").select(
        "user_id",
        "username",
        "stream_count",
        "songs_played",
        "total_listen_time",
        percentage("skipped", "stream_count").alias("skip_rate"),
        percentage("liked", "stream_count").alias("like_rate"),
    )


def activity_by_weekday(events: DataFrame) -> DataFrame:
    """Sunday is day 1."""
    return (
        events.groupBy(F.dayofweek("timestamp").alias("day_of_week"))
        .agg(row_count().alias("stream_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy("day_of_week")
    )


def popular_genres_by_region(events: DataFrame, songs: DataFrame, locations: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most played genres of each region."""
    played = per_key(events, ["song_id", "location_id"], stream_count())
    placed = played.join(locations.select("location_id", "region"), "location_id")
    regional = regroup(placed, ["region", "song_id"], ["stream_count"])
    by_genre = regroup(
        regional.join(songs.select("song_id", "genre"), "song_id"), ["region", "genre"], ["stream_count"]
    )
    order = Window.partitionBy("region").orderBy(F.desc("stream_count"), "genre")
    return by_genre.withColumn("genre_rank", F.row_number().over(order)).where(F.col("genre_rank") <= n)


def engagement_by_subscription(events: DataFrame, users: DataFrame) -> DataFrame:
    totals = stream_count() | {"liked": flagged("is_liked")}
    per_user = per_key(events, ["user_id"], totals)
    return regroup(
        per_user.join(users.select("user_id", "subscription_type"), "user_id"),
        ["subscription_type"],
        list(totals),
        extra=[F.count_distinct("user_id").alias("unique_users")],
    ).select(
        "subscription_type",
        "stream_count",
        "unique_users",
        rounded_quotient("stream_count", "unique_users").alias("streams_per_user"),
        percentage("liked", "stream_count").alias("like_rate"),
    )


def completion_by_device_type(events: DataFrame, devices: DataFrame) -> DataFrame:
    totals = {"total_streams": row_count(), "completed_streams": flagged("is_complete_play")}
    return by_attribute(events, devices, "device_id", ["device_type"], totals).withColumn(
        "completion_rate", percentage("completed_streams", "total_streams")
    )


def listen_time_by_device_type_and_os(events: DataFrame, devices: DataFrame) -> DataFrame:
    return by_attribute(
        events, devices, "device_id", ["device_type", "os"], means={"avg_listen_time": "stream_duration_seconds"}
    )


def users_by_country(events: DataFrame, locations: DataFrame) -> DataFrame:
    return activity_by_place(events, locations, "country").select("country", "unique_users")


def activity_by_region(events: DataFrame, locations: DataFrame) -> DataFrame:
    return activity_by_place(events, locations, "region")
