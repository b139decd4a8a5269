"""Stored batches: what counts, what a replay replaces, what is compared with what, merges."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from playstream.model import SONGS, STREAM_EVENTS, USER_BITMAPS
from playstream.plans import additive
from playstream.sinks import keyfilter
from playstream.sinks.commits import Commit, live
from playstream.sinks.store import FileStore, KeyCheck
from playstream.streaming.delivery import Delivery
from tests.helpers import dimensions, event, events, rows, table

NOON = datetime(2024, 1, 30, 12)


def ids(store, spark):
    return [r[0] for r in rows(store.read(spark, STREAM_EVENTS), "event_id")]


def test_a_batch_that_ends_half_way_is_not_seen(spark, tmp_path):
    store = FileStore(str(tmp_path))
    store.write(events(spark, [event(1)]), STREAM_EVENTS, 0)
    broken = events(spark, [event(n) for n in range(2, 40)]).repartition(8)
    broken = broken.where(F.when(F.col("event_id") == "ev-30", F.raise_error(F.lit("lost"))).otherwise(F.lit(True)))
    with pytest.raises(Exception, match="lost"):
        store.write(broken, STREAM_EVENTS, 1)
    # files that were finished, but whose batch never was
    events(spark, [event(99)]).write.parquet(f"{tmp_path}/stream_events/folder=w0/event_date=2024-01-30")
    assert ids(store, spark) == ["ev-1"]
    store.write(events(spark, [event(2)]), STREAM_EVENTS, 1)
    assert ids(store, spark) == ["ev-1", "ev-2"]


def test_a_batch_run_again_leaves_no_date_and_no_letter(spark, tmp_path):
    store, known = FileStore(str(tmp_path)), {"n": 3}
    delivery = Delivery(store, lambda s: dimensions(s, known["n"]))
    batch = events(spark, [event(1), event(2, user=3, time="2024-01-28 09:00:00"), event(3, device=4)])
    delivery.deliver(batch, 7, STREAM_EVENTS)
    assert ids(store, spark) == ["ev-1", "ev-2"] and store.read_dead_letters(spark, "stream_events").count() == 1
    known["n"] = 2
    delivery.deliver(batch, 7, STREAM_EVENTS)
    assert ids(store, spark) == ["ev-1"] and store.read_dead_letters(spark, "stream_events").count() == 2
    assert store.read_period(spark, STREAM_EVENTS, "2024-01-28", "2024-01-28").count() == 0
    known["n"] = 4
    delivery.deliver(batch, 7, STREAM_EVENTS)
    assert ids(store, spark) == ["ev-1", "ev-2", "ev-3"]
    assert store.read_dead_letters(spark, "stream_events").count() == 0


def hour(n, first, count=5):
    """Events ``first``, ``first + 1``, ... of the n-th hour of a day."""
    at = datetime(2024, 1, 30) + timedelta(hours=n)
    return [event(i, time=str(at + timedelta(minutes=i % 50))) for i in range(first, first + count)]


def test_only_writes_with_a_key_of_the_batch_are_opened(spark, tmp_path):
    store = FileStore(str(tmp_path))
    delivery = Delivery(store)
    checks = []
    for n in range(6):
        delivery.deliver(events(spark, hour(n, 100 * n)), n, STREAM_EVENTS)
        checks.append(store.last_check)
    assert checks == [KeyCheck(0, 0)] * 6  # hours do not meet
    delivery.deliver(events(spark, hour(3, 1000)), 6, STREAM_EVENTS)
    assert store.last_check == KeyCheck(1, 0)  # the same hour, other keys
    delivery.deliver(events(spark, [*hour(2, 202), *hour(5, 2000)]), 7, STREAM_EVENTS)
    assert store.last_check == KeyCheck(5, 1)
    got = ids(store, spark)
    assert len(got) == len(set(got)) == 6 * 5 + 5 + 2 + 5


def test_key_filters_know_their_keys(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) AS k", "cast(id % 7 AS int) AS n")
    bits = keyfilter.bits_for(20_000)
    filters = keyfilter.built(keys, ["k", "n"], bits).withColumn("folder", F.lit("a"))
    both = filters.unionByName(keyfilter.built(keys.limit(0).unionByName(keys.where("n = 3")), ["k", "n"], bits).withColumn("folder", F.lit("b")))
    assert keyfilter.folders_with(keys.where("k = 'k10'"), ["k", "n"], both, bits) == {"a", "b"}
    assert keyfilter.folders_with(keys.where("k = 'k11'"), ["k", "n"], both, bits) == {"a"}
    strangers = spark.range(400).selectExpr("concat('x', id) AS k", "1 AS n")
    wrong = sum(bool(keyfilter.folders_with(strangers.where(f"k = 'x{i}'"), ["k", "n"], filters, bits)) for i in range(5))
    assert wrong <= 1
    assert keyfilter.bits_for(1) == keyfilter.BITMAP and keyfilter.bits_for(10**6) == 1 << 24


def test_merged_writes_hold_the_same_rows(spark, tmp_path):
    store = FileStore(str(tmp_path))
    for n in range(5):
        store.write(events(spark, hour(n, 100 * n)), STREAM_EVENTS, n, "q")
    assert store.merge(spark, STREAM_EVENTS, fan_in=6) is None
    before, reading = ids(store, spark), store.read(spark, STREAM_EVENTS)
    merged = store.merge(spark, STREAM_EVENTS, fan_in=3)
    assert merged.rows == 25 and [c.number for c in store.commits(spark, STREAM_EVENTS)] == [merged.number]
    assert ids(store, spark) == before == [r[0] for r in rows(reading, "event_id")]
    assert store.merge(spark, STREAM_EVENTS, fan_in=2) is None
    others = store.read(spark, STREAM_EVENTS, other_than_batch=4, run="q")
    assert rows(others, "event_id") == [(i,) for i in before if not i.startswith("ev-40")]
    store.write(events(spark, hour(9, 900, 1)), STREAM_EVENTS, 2, "q")  # the batch is run again after the merge
    assert ids(store, spark) == sorted([i for i in before if not i.startswith("ev-20")] + ["ev-900"])


def test_entries_in_force():
    def entry(number, batch, replaces=(), run="q"):
        return Commit(number, run, batch, f"w{number}", 1, replaces=replaces)

    numbers = lambda entries: [e.number for e in live(entries)]
    parts = [entry(1, 0), entry(2, 1), entry(3, 2)]
    assert numbers([*parts, entry(4, 1)]) == [1, 3, 4]
    merged = entry(4, 2, (1, 2), "merge")
    assert numbers([*parts, merged]) == [3, 4]
    assert numbers([*parts, merged, entry(5, 4, (4, 3), "merge")]) == [5]
    assert numbers([*parts, merged, entry(5, 0)]) == [2, 3, 5]
    assert numbers([*parts, entry(4, 1, run="other")]) == [1, 2, 3, 4]


def test_tables_without_times(spark, tmp_path):
    store = FileStore(str(tmp_path))
    assert store.read(spark, SONGS).count() == 0
    store.write(table(spark, "songs", {"song_id": 1, "title": "a"}), SONGS, 0)
    store.write(table(spark, "songs", {"song_id": 2, "title": "b"}), SONGS, 1)
    store.write(table(spark, "songs", {"song_id": 3, "title": "c"}), SONGS, 0)
    assert rows(store.read(spark, SONGS), "song_id") == [(2,), (3,)]
    store.withdraw(spark, SONGS, 1)
    assert rows(store.read(spark, SONGS), "song_id") == [(3,)]


def test_times_bound_what_is_read(spark, tmp_path):
    store = FileStore(str(tmp_path))
    store.write(events(spark, [event(1, time="2024-01-01 00:00:00")]), STREAM_EVENTS, 0)
    store.write(events(spark, [event(2, time="2024-01-30 11:59:59.999999"), event(3, time=str(NOON))]), STREAM_EVENTS, 1)
    recent = store.read(spark, STREAM_EVENTS, since=NOON)
    assert rows(recent, "event_id") == [("ev-3",)] and len(recent.inputFiles()) == 1


def test_bitmaps_and_rates_add_up(spark):
    first = [event(i, user=u, time=f"2024-01-01 00:{i:02d}:00", is_skipped=i % 2 == 0) for i, u in enumerate([1, 40_000, 1, 70_000])]
    second = [event(9, user=1, time="2024-01-01 23:59:59"), event(10, user=None), event(11, user=5, seconds=None)]
    parts = [events(spark, p) for p in (first, second)]
    bitmaps = parts[0].transform(additive.additive, USER_BITMAPS.name).unionByName(parts[1].transform(additive.additive, USER_BITMAPS.name))
    assert rows(additive.users_by_day(bitmaps)) == [(datetime(2024, 1, 1).date(), 3), (NOON.date(), 1)]
    sums = parts[0].transform(additive.additive, "hourly_sums").unionByName(parts[1].transform(additive.additive, "hourly_sums"))
    sums = sums.unionByName(events(spark, [event(12, time="2024-01-01 00:30:00", seconds=10)]).transform(additive.additive, "hourly_sums"))
    got = {r.time_window.hour: r for r in additive.hourly_rates(sums).where("time_window < '2024-01-02'").collect()}
    assert (got[0].stream_count, got[0].avg_listen_time, got[0].skip_rate) == (5, 50.0, 0.4) and got[23].stream_count == 1
    (last,) = additive.hourly_rates(sums).where("time_window > '2024-01-02'").collect()
    assert (last.stream_count, last.total_listen_time, last.avg_listen_time) == (2, 60, 60.0)
