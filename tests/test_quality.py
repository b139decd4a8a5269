import pytest

from playstream.model import STREAM_EVENTS
from playstream.plans import metrics, quality
from playstream.sources.star import StarSchema
from tests.helpers import dimensions, event, events, rows


# Orphans and NULL users measured on the supplied tables.
@pytest.mark.parametrize(
    "scale, expected, unknown",
    [
        ("0.001", {"song": 20, "artist": 91, "album": 10, "device": 91, "location": 38, "user": 0}, 10),
        ("0.01", {"song": 20, "artist": 99, "album": 10, "device": 99, "location": 384, "user": 0}, 100),
    ],
)
def test_orphans_of_the_supplied_tables(spark, scale, expected, unknown):
    star = StarSchema(spark, f"/root/testdata/sf{scale}")
    got = {r["issue"]: r["count"] for r in quality.orphan_counts(star.stream_events, star.dimensions()).collect()}
    assert got == {f"Orphaned {name}_id": n for name, n in expected.items()}
    assert star.stream_events.where("user_id IS NULL").count() == unknown


def test_every_reference_is_listed_without_orphans(spark):
    df = events(spark, [event(1), event(2, user=None)])
    got = rows(quality.orphan_counts(df, dimensions(spark)))
    assert got == sorted((f"Orphaned {r.column}", 0) for r in STREAM_EVENTS.references)


def literal_reconciliation(spark, metric, plays, minutes, inclusive):
    metric.createOrReplaceTempView("m")
    plays.createOrReplaceTempView("e")
    end = "<=" if inclusive else "<"
    return spark.sql(
        f"""SELECT m.user_id, m.stream_count, count(*) AS recount, abs(m.stream_count - count(*)) AS off
            FROM m JOIN e ON m.user_id = e.user_id AND e.`timestamp` >= m.time_window
             AND e.`timestamp` {end} m.time_window + INTERVAL {minutes} MINUTES
            GROUP BY m.user_id, m.time_window, m.stream_count
            HAVING abs(m.stream_count - count(*)) > 0"""
    )


@pytest.mark.parametrize(
    "minutes, inclusive", [(5, True), (5, False), (1, True), (1, False), (3, True), (60, True), (75, True), (75, False)]
)
def test_reconciliation_equals_the_range_join(spark, minutes, inclusive):
    times = (
        "00:00:00 00:00:30 00:01:00 00:04:59.999999 00:05:00 00:05:00.000001 00:06:00 00:11:00 "
        "00:58:10 00:59:59.999999 01:00:00 01:03:00 01:04:00 01:05:00 01:14:00 02:00:00 03:15:00 23:59:59"
    ).split()
    stamps = [f"2024-01-01 {t}" for t in times] + ["2024-01-02 00:00:00", "2024-01-02 00:04:00"]
    df = events(
        spark, [event(n, user=u, time=t) for n, (u, t) in enumerate((u, t) for u in (1, 2, None) for t in stamps)]
    )
    metric = metrics.windowed(df, "user_engagement_metrics").select("time_window", "user_id", "stream_count")
    # Metric rows that are wrong, and some of minutes without any event.
    wrong = metric.selectExpr("time_window", "user_id", "stream_count + if(user_id = 2, 1, 0) AS stream_count")
    idle = metric.selectExpr("time_window - INTERVAL 2 MINUTES AS time_window", "user_id", "7L AS stream_count")
    claimed = wrong.unionByName(idle.join(wrong, ["time_window", "user_id"], "left_anti").distinct())
    got = quality.metrics_reconciliation(claimed, df, minutes, inclusive, n=None)
    assert rows(got) == rows(literal_reconciliation(spark, claimed, df, minutes, inclusive))


def test_exact_reconciliation_of_right_metrics_is_empty(star):
    metric = metrics.windowed(star.stream_events, "user_engagement_metrics")
    assert quality.metrics_reconciliation(metric, star.stream_events, 1, False, n=None).count() == 0


def test_completeness_is_one_row(star):
    got = quality.dimension_completeness(star.stream_events, star.dimensions()).collect()
    assert len(got) == 1 and len(got[0]) == 10
    assert got[0].devices_in_dimension == 10
