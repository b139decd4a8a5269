"""Hot keys and plan shapes."""

import pytest
from pyspark.sql import functions as F

from playstream.model import STREAM_EVENTS
from playstream.operators import integrity
from playstream.plans import business, catalog, metrics, quality
from tests.conftest import SMALL
from tests.helpers import rows


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 plays, a third of them by one user of one song on one device."""
    return (
        spark.range(20_000)
        .selectExpr(
            "concat('ev-', id) AS event_id",
            "CAST(if(id % 3 = 0, 1, id % 50) AS INT) AS user_id",
            "CAST(if(id % 3 = 0, 1, id % 40) AS INT) AS song_id",
            "CAST(id % 20 AS INT) AS artist_id",
            "CAST(5 * (id % 8) AS INT) AS album_id",
            "CAST(if(id % 3 = 0, 1, id % 12) AS INT) AS device_id",
            "CAST(id % 25 AS INT) AS location_id",
            "timestamp_ntz'2024-01-29 00:00:00' + make_dt_interval(0, 0, 0, id * 8) AS timestamp",
            "CAST(id % 300 AS INT) AS stream_duration_seconds",
            "id % 2 = 0 AS is_complete_play",
            "id % 5 = 0 AS is_skipped",
            "id % 7 = 0 AS is_liked",
            "id % 10 = 3 AS is_shared",
            "id % 11 = 0 AS is_added_to_playlist",
        )
        .cache()
    )


def test_reports_on_hot_keys(hot, star):
    direct = (
        hot.join(star.songs, "song_id")
        .join(star.artists.withColumnRenamed("name", "artist_name"), "artist_id")
        .groupBy("title", "artist_name")
        .agg(F.count("*").alias("stream_count"))
        .orderBy(F.desc("stream_count"), "title", "artist_name")
        .limit(10)
    )
    assert rows(business.top_songs(hot, star.songs, star.artists)) == rows(direct, "title", "artist_name", "stream_count")
    total = sum(r.stream_count for r in business.activity_by_device(hot, star.devices).collect())
    assert total == hot.where("device_id < 10").count()


def test_reconciliation_of_a_hot_user(hot):
    metric = metrics.windowed(hot, "user_engagement_metrics")
    assert quality.metrics_reconciliation(metric, hot, 1, False, n=None).count() == 0
    assert quality.metrics_reconciliation(metric, hot, n=None).count() > 0


def test_integrity_of_hot_broken_keys(hot, star):
    dims = star.dimensions()
    dims["songs"] = dims["songs"].where("song_id <> 1")
    good, bad = integrity.split_by_references(hot, STREAM_EVENTS, dims, hold=lambda df: df.cache())
    assert bad.where("song_id = 1").count() == hot.where("song_id = 1").count()
    assert good.count() + bad.count() == hot.count()


BATCH = [name for name in catalog.queries() if not name.startswith(("stream_", "fk_", "dead_", "replayed_"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_query_pairs_rows_without_keys(spark, name):
    plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in plan
