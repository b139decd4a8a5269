"""Business questions over play events and dimensions."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.functions.measures import flagged, percentage, rounded_quotient, row_count
from playstream.functions.timeparts import age_band, moment, since
from playstream.operators.rollup import by_attribute, per_key, regroup, stream_count

DAY = timedelta(hours=24)


def top(df: DataFrame, n: int, measure: str, *ties: str) -> DataFrame:
    """The ``n`` largest, ties settled by the given columns."""
    return df.orderBy(F.desc(measure), *ties).limit(n)


def top_songs(events: DataFrame, songs: DataFrame, artists: DataFrame, n: int = 10) -> DataFrame:
    """Most played (title, artist) pairs; equal names count together."""
    plays = per_key(events, ["song_id", "artist_id"], stream_count())
    named = plays.join(songs.select("song_id", "title"), "song_id").join(
        artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id"
    )
    return top(regroup(named, ["title", "artist_name"], ["stream_count"]), n, "stream_count", "title", "artist_name")


def top_users(events: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    totals = stream_count() | {"total_listen_time": F.sum("stream_duration_seconds")}
    counted = by_attribute(events, users, "user_id", ["username", "subscription_type"], totals)
    return top(counted, n, "stream_count", "username", "subscription_type")


def activity_by_hour(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.hour("timestamp").alias("hour_of_day"))
        .agg(row_count().alias("stream_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy("hour_of_day")
    )


def activity_by_device(events: DataFrame, devices: DataFrame) -> DataFrame:
    return by_attribute(
        events,
        devices,
        "device_id",
        ["device_type", "os"],
        stream_count(),
        {"avg_listen_time": "stream_duration_seconds"},
    ).orderBy(F.desc("stream_count"), "device_type", "os")


def flag_rate_by_genre(events: DataFrame, songs: DataFrame, flag: str, counted_as: str, rate_as: str) -> DataFrame:
    totals = {"total_streams": row_count(), counted_as: flagged(flag)}
    return (
        by_attribute(events, songs, "song_id", ["genre"], totals)
        .withColumn(rate_as, percentage(counted_as, "total_streams"))
        .orderBy(F.desc(rate_as), "genre")
    )


def skip_rate_by_genre(events: DataFrame, songs: DataFrame) -> DataFrame:
    return flag_rate_by_genre(events, songs, "is_skipped", "skipped_streams", "skip_rate")


def like_rate_by_genre(events: DataFrame, songs: DataFrame) -> DataFrame:
    return flag_rate_by_genre(events, songs, "is_liked", "liked_streams", "like_rate")


def activity_by_place(events: DataFrame, locations: DataFrame, attribute: str) -> DataFrame:
    """Plays and distinct users per place, from one row per (location, user)."""
    visits = per_key(events, ["location_id", "user_id"], stream_count())
    placed = visits.join(locations.select("location_id", attribute), "location_id")
    return regroup(
        placed, [attribute], ["stream_count"], extra=[F.count_distinct("user_id").alias("unique_users")]
    )


def activity_by_country(events: DataFrame, locations: DataFrame, n: int = 20) -> DataFrame:
    return top(activity_by_place(events, locations, "country"), n, "stream_count", "country")


def _per_user(events: DataFrame, flags: dict[str, str]) -> DataFrame:
    totals = stream_count() | {name: flagged(flag) for name, flag in flags.items()}
    return per_key(events, ["user_id"], totals, {"avg_listen_time": "stream_duration_seconds"})


def activity_by_subscription(events: DataFrame, users: DataFrame) -> DataFrame:
    flags = {"skipped": "is_skipped", "completed": "is_complete_play"}
    return (
        regroup(
            _per_user(events, flags).join(users.select("user_id", "subscription_type"), "user_id"),
            ["subscription_type"],
            ["stream_count", *flags],
            ["avg_listen_time"],
            [F.count_distinct("user_id").alias("unique_users")],
        )
        .select(
            "subscription_type",
            "stream_count",
            "unique_users",
            "avg_listen_time",
            percentage("skipped", "stream_count").alias("skip_rate"),
            percentage("completed", "stream_count").alias("completion_rate"),
        )
        .orderBy(F.desc("stream_count"), "subscription_type")
    )


def engagement_by_age_group(events: DataFrame, users: DataFrame) -> DataFrame:
    flags = {"skipped": "is_skipped", "liked": "is_liked", "shared": "is_shared"}
    banded = _per_user(events, flags).join(users.select("user_id", age_band().alias("age_group")), "user_id")
    return (
        regroup(
            banded,
            ["age_group"],
            ["stream_count", *flags, "avg_listen_time__sum", "avg_listen_time__n"],
            extra=[F.count_distinct("user_id").alias("unique_users")],
        )
        .select(
            "age_group",
            "unique_users",
            "stream_count",
            rounded_quotient("stream_count", "unique_users").alias("streams_per_user"),
            rounded_quotient("avg_listen_time__sum", "avg_listen_time__n").alias("avg_listen_time"),
            percentage("skipped", "stream_count").alias("skip_rate"),
            percentage("liked", "stream_count").alias("like_rate"),
            percentage("shared", "stream_count").alias("share_rate"),
        )
        .orderBy("age_group")
    )


def period_counts(events: DataFrame, as_of: datetime, period: timedelta = DAY) -> DataFrame:
    """Plays per song in the last period and the one before it.

    One scan of two periods with two conditional counts gives the rows of a full
    outer join of two grouped scans, zeros in place of missing sides.
    """
    latest = F.col("timestamp") >= moment(as_of - period)
    return (
        events.where(since("timestamp", as_of, 2 * period))
        .groupBy("song_id")
        .agg(
            F.count_if(latest).alias("last_24h_streams"),
            F.count_if(~latest).alias("previous_24h_streams"),
        )
    )


def trending_songs(
    events: DataFrame, songs: DataFrame, artists: DataFrame, as_of: datetime, n: int = 20
) -> DataFrame:
    """Songs by growth between two periods, with every artist they were played with."""
    pairs = events.select("song_id", "artist_id").distinct()
    change = F.col("last_24h_streams") - F.col("previous_24h_streams")
    grown = (
        period_counts(events, as_of)
        .withColumn("change", change)
        .withColumn(
            "growth_percent",
            F.when(F.col("previous_24h_streams") == 0, F.lit(100.0)).otherwise(
                percentage("change", "previous_24h_streams")
            ),
        )
    )
    named = (
        grown.join(songs.select("song_id", "title"), "song_id")
        .join(pairs, "song_id")
        .join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
        .select("title", "artist_name", "last_24h_streams", "previous_24h_streams", "growth_percent")
        .distinct()
    )
    return top(
        named, n, "growth_percent", "title", "artist_name", "last_24h_streams", "previous_24h_streams"
    )
