import pytest

from playstream.plans import metrics
from tests.helpers import at, event, events, rows


def test_window_edges(spark):
    df = events(
        spark, [event(1, time="2024-01-01 00:00:59.999999"), event(2, time="2024-01-01 00:01:00")]
    )
    got = rows(metrics.windowed(df, "user_engagement_metrics"), "time_window", "stream_count")
    assert got == [(at("2024-01-01 00:00:00"), 1), (at("2024-01-01 00:01:00"), 1)]


def test_a_missing_flag_counts_in_the_denominator_only(spark):
    df = events(spark, [event(1, is_skipped=None), event(2, is_skipped=True), event(3), event(4)])
    assert rows(metrics.windowed(df, "user_engagement_metrics"), "skip_rate") == [(0.25,)]


def test_events_without_a_time_have_no_window(spark):
    df = events(spark, [event(1, time=None), event(2)])
    assert rows(metrics.windowed(df, "hourly_metrics"), "stream_count") == [(1,)]


def test_an_unknown_user_is_a_group(spark):
    df = events(spark, [event(1, user=None), event(2, user=None), event(3)])
    got = rows(metrics.windowed(df, "user_engagement_metrics"), "user_id", "stream_count")
    assert got == [(1, 1), (None, 2)]


def test_columns_follow_the_stored_tables(star):
    from playstream.model import METRIC_TABLES

    for t in METRIC_TABLES:
        df = metrics.windowed(star.stream_events, t.name)
        assert df.columns == t.columns
        assert [f.dataType for f in df.schema.fields] == [f.dataType for f in t.schema.fields]


@pytest.mark.parametrize("column", ["unique_users", "unique_songs", "unique_artists"])
def test_approximate_counts_stay_close(star, column):
    exact = {r.time_window: r[column] for r in metrics.windowed(star.stream_events, "hourly_metrics").collect()}
    close = metrics.windowed(star.stream_events, "hourly_metrics", exact_distinct=False).collect()
    assert len(close) == len(exact)
    for r in close:
        assert abs(r[column] - exact[r.time_window]) <= max(1, 0.15 * exact[r.time_window])


def test_a_period_bound_reaches_the_scan(star):
    from datetime import datetime, timedelta

    df = metrics.windowed_since(
        star.stream_events, "hourly_metrics", datetime(2024, 1, 31), timedelta(hours=24)
    ).select("time_window", "stream_count")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-30T00:00)" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan
