from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playstream.functions.measures import percentage, rounded_quotient
from playstream.functions.timeparts import age_band, before, since
from playstream.plans import business
from tests.helpers import dimensions, event, events, rows, table

AS_OF = datetime(2024, 1, 31)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(1, 10**9)), min_size=1, max_size=40))
def test_rounding_is_exact_and_half_up(spark, pairs):
    df = spark.createDataFrame(pairs, "p long, w long").select(
        "p", "w", percentage("p", "w").alias("pct"), rounded_quotient("p", "w").alias("quo")
    )
    for r in df.collect():
        for value, factor in ((r.pct, 100), (r.quo, 1)):
            exact = Decimal(r.p * factor) / Decimal(r.w)
            assert value == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_rounding_of_ties_and_empty_groups(spark):
    df = spark.createDataFrame([(1, 32), (-1, 32), (1, 0)], "p long, w long")
    assert [r[0] for r in df.select(percentage("p", "w")).collect()] == [3.13, -3.13, None]


def test_age_bands(spark):
    ages = [None, 17, 18, 24, 25, 34, 35, 44, 45, 54, 55]
    df = spark.createDataFrame([(a,) for a in ages], "age int").select(age_band())
    assert [r[0] for r in df.collect()] == [
        "55+", "Under 18", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+",
    ]


def test_growth_of_songs_played_in_one_period_only(spark):
    df = events(
        spark,
        [
            event(1, song=1, time="2024-01-30 00:00:00"),
            event(2, song=2, time="2024-01-29 23:59:59.999999"),
            event(3, song=3, time="2024-01-28 23:59:59"),
            event(4, song=None, time="2024-01-30 05:00:00"),
        ],
    )
    dims = dimensions(spark)
    got = business.trending_songs(df, dims["songs"], dims["artists"], AS_OF).collect()
    assert [(r.title, r.last_24h_streams, r.previous_24h_streams, r.growth_percent) for r in got] == [
        ("title 1", 1, 0, 100.0),
        ("title 2", 0, 1, -100.0),
    ]


def test_period_counts_equal_a_full_outer_join(star):
    plays, day = star.stream_events, timedelta(hours=24)
    latest = plays.where(since("timestamp", AS_OF, day)).groupBy("song_id").agg(F.count("*").alias("l"))
    earlier = (
        plays.where(since("timestamp", AS_OF, 2 * day) & before("timestamp", AS_OF, day))
        .groupBy("song_id")
        .agg(F.count("*").alias("p"))
    )
    joined = latest.join(earlier, "song_id", "full_outer").select(
        "song_id", F.coalesce("l", F.lit(0)), F.coalesce("p", F.lit(0))
    )
    assert rows(business.period_counts(plays, AS_OF)) == rows(joined)


def test_equal_titles_count_together(spark):
    songs = table(spark, "songs", {"song_id": 1, "title": "Same"}, {"song_id": 2, "title": "Same"})
    artists = dimensions(spark)["artists"]
    df = events(spark, [event(1, song=1), event(2, song=2)])
    assert rows(business.top_songs(df, songs, artists), "title", "stream_count") == [("Same", 2)]


def test_ties_are_settled_by_name(spark):
    dims = dimensions(spark)
    df = events(spark, [event(1, song=2), event(2, song=1), event(3, song=3)])
    assert [r.title for r in business.top_songs(df, dims["songs"], dims["artists"], 2).collect()] == [
        "title 1",
        "title 2",
    ]


def test_aggregating_before_the_join_changes_nothing(star):
    direct = (
        star.stream_events.join(star.users, "user_id")
        .groupBy("subscription_type")
        .agg(
            F.count("*").alias("stream_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.avg("stream_duration_seconds").alias("avg_listen_time"),
        )
    )
    got = business.activity_by_subscription(star.stream_events, star.users)
    assert rows(got, *direct.columns) == rows(direct)
