import json
from datetime import datetime

from pyspark.sql import functions as F

from playstream.model import STREAM_EVENTS
from playstream.operators import deadletter, integrity
from tests.helpers import dimensions, event, events, rows

AT = datetime(2024, 1, 31)


def batch(spark):
    return events(
        spark,
        [
            event(1, user=901),
            event(2, user=902, song=77),
            event(3, user=None),
            event(4),
            event(5, time=None),
        ],
    )


def test_all_bad_keys_are_found_and_null_keys_pass(spark):
    good, bad = integrity.split_by_references(batch(spark), STREAM_EVENTS, dimensions(spark))
    assert rows(good, "event_id") == [("ev-3",), ("ev-4",)]
    assert rows(bad, "event_id", F.concat_ws("; ", integrity.REASONS)) == [
        ("ev-1", "Foreign key violation: user_id=901"),
        ("ev-2", "Foreign key violation: user_id=902; Foreign key violation: song_id=77"),
        ("ev-5", "Missing required value: timestamp"),
    ]


def test_counted_and_uncounted_keys_give_the_same_split(spark, star):
    plain = integrity.split_by_references(star.stream_events, STREAM_EVENTS, star.dimensions())
    held = integrity.split_by_references(star.stream_events, STREAM_EVENTS, star.dimensions(), hold=lambda df: df)
    for one, other in zip(plain, held):
        assert rows(one) == rows(other)
    assert plain[0].count() + plain[1].count() == star.stream_events.count()


def test_rows_are_not_shuffled_when_broken_keys_are_few(spark, star):
    dims = star.dimensions()
    broken = integrity.broken_keys(star.stream_events, dims, STREAM_EVENTS.references).cache()
    broken.count()  # from here on Spark knows their size
    checked = integrity.with_reasons(star.stream_events, STREAM_EVENTS, broken, integrity.broken_sizes(broken))
    plan = checked._jdf.queryExecution().executedPlan().toString()
    joins, _, _ = plan.partition("InMemoryRelation")
    assert "SortMergeJoin" not in joins and "BroadcastHashJoin" in joins


def test_dead_letter_form(spark):
    _, bad = integrity.split_by_references(batch(spark), STREAM_EVENTS, dimensions(spark))
    letters = deadletter.to_dead_letters(bad.where("event_id = 'ev-1'"), "stream_events", 7, AT)
    assert letters.columns == ["value"]
    record = json.loads(letters.first().value)
    assert record["event_id"] == "ev-1" and record["user_id"] == 901
    assert record["timestamp"] == "2024-01-30T12:00:00.000000"
    assert json.loads(record["error_info"]) == {
        "table": "stream_events",
        "batch_id": 7,
        "error_message": "Foreign key violation: user_id=901",
        "timestamp": "2024-01-31 00:00:00",
    }


def test_missing_values_are_left_out_of_dead_letters(spark):
    rejected = batch(spark).where("event_id = 'ev-5'")
    record = json.loads(deadletter.to_dead_letters(rejected, "stream_events", 0, AT, "down").first().value)
    assert "timestamp" not in record and json.loads(record["error_info"])["error_message"] == "down"


def test_dead_letters_can_be_replayed(spark):
    dims = dimensions(spark)
    _, bad = integrity.split_by_references(batch(spark), STREAM_EVENTS, dims)
    letters = deadletter.to_dead_letters(bad, "stream_events", 3, AT)
    again = deadletter.read_dead_letters(letters, STREAM_EVENTS)
    assert rows(again, "failed_batch_id") == [(3,)] * 3
    dims["users"] = dims["users"].unionByName(
        spark.createDataFrame([(901,)], "user_id int"), allowMissingColumns=True
    )
    good, still = integrity.split_by_references(again.select(*STREAM_EVENTS.columns), STREAM_EVENTS, dims)
    assert rows(good) == rows(batch(spark).where("event_id = 'ev-1'"))
    assert rows(still, "event_id") == [("ev-2",), ("ev-5",)]
