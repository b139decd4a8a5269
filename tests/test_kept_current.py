"""Tables kept from changes, rows that wait for keys, reconciliation by digests, lists that add up."""

from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from playstream.model import CURRENT_USERS, STREAM_EVENTS, USER_ENGAGEMENT
from playstream.operators.integrity import known_keys
from playstream.plans import digests, frequent, metrics
from playstream.sinks.keyed import KeyedTable
from playstream.sinks.store import FileStore, settled
from playstream.sinks.waiting import WaitingRows
from playstream.streaming import job
from playstream.streaming.delivery import Delivery
from tests.helpers import dimensions, event, events, rows

NOON = datetime(2024, 1, 30, 12)


def changes(spark, keyed, *given):
    """``(user, device, order)`` or, of a delete, ``(user, None, order)``."""
    made = [(u, d, 1, NOON, n, d is None) for u, d, n in given]
    return spark.createDataFrame(made, keyed.changes.schema)


def held(keyed, spark):
    return rows(keyed.read(spark), "user_id", "device_id")


def test_newest_change_counts_in_whatever_order_batches_come(spark, tmp_path):
    keyed = KeyedTable(FileStore(str(tmp_path)), CURRENT_USERS)
    assert held(keyed, spark) == []
    keyed.apply(changes(spark, keyed, (1, 15, 5), (2, 21, 1), (3, 31, 1), (1, 14, 4)), 0)
    keyed.apply(changes(spark, keyed, (1, 12, 2), (2, None, 7), (None, 9, 9)), 1)
    keyed.apply(changes(spark, keyed, (2, 26, 6), (3, 32, 2)), 2)
    assert held(keyed, spark) == [(1, 15), (3, 32)]
    keyed.apply(changes(spark, keyed, (2, 28, 8)), 3)
    assert held(keyed, spark) == [(1, 15), (2, 28), (3, 32)]
    # run again with other rows: the earlier ones are gone
    keyed.apply(changes(spark, keyed, (3, 33, 3)), 3)
    assert held(keyed, spark) == [(1, 15), (3, 33)]


def test_merges_change_nothing_and_a_batch_of_them_can_run_again(spark, tmp_path):
    keyed = KeyedTable(FileStore(str(tmp_path)), CURRENT_USERS)
    for batch in range(4):
        keyed.apply(changes(spark, keyed, *[(u, 10 * u + batch, 4 * u + batch) for u in range(6)]), batch)
        assert keyed.compact(spark) is None or batch == 3
    (only,) = keyed.store.commits(spark, keyed.changes)
    assert only.rows == 6 and held(keyed, spark) == [(u, 10 * u + 3) for u in range(6)]
    keyed.apply(changes(spark, keyed, (0, None, 99)), 2)
    assert held(keyed, spark) == [(u, 10 * u + 3) for u in range(1, 6)]


def test_large_writes_are_left_alone(spark, tmp_path):
    keyed = KeyedTable(FileStore(str(tmp_path)), CURRENT_USERS)
    keyed.apply(changes(spark, keyed, *[(u, 1, u) for u in range(100)]), 0)
    for batch in (1, 2):
        keyed.apply(changes(spark, keyed, (batch, 5, 1000 + batch)), batch)
    assert keyed.compact(spark, fan_in=2).rows == 2
    assert sorted(c.rows for c in keyed.store.commits(spark, keyed.changes)) == [2, 100]


def test_deletes_go_once_nothing_is_left_that_they_hide(spark, tmp_path):
    keyed = KeyedTable(FileStore(str(tmp_path)), CURRENT_USERS)
    keyed.apply(changes(spark, keyed, (1, 11, 1), (2, 21, 2), (3, 31, 3)), 0)
    keyed.apply(changes(spark, keyed, (1, None, 4), (2, None, 9)), 1)
    assert keyed.compact(spark, fan_in=2, settled_before=5).rows == 2
    assert held(keyed, spark) == [(3, 31)]
    keyed.apply(changes(spark, keyed, (2, 28, 8)), 2)
    assert held(keyed, spark) == [(3, 31)]


def test_a_stream_of_changes_goes_on_after_a_restart(spark, tmp_path):
    keyed = KeyedTable(FileStore(f"{tmp_path}/tables"), CURRENT_USERS)

    def run():
        arrived = spark.readStream.schema(keyed.changes.schema).option("maxFilesPerTrigger", 1)
        job.start_changelog(
            arrived.parquet(f"{tmp_path}/in"), keyed, f"{tmp_path}/checkpoints", job.Schedule(drain=True), fan_in=2
        ).awaitTermination()
        return held(keyed, spark)

    def arrive(*given):
        changes(spark, keyed, *given).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    arrive((1, 13, 3), (2, 21, 1))
    arrive((1, 12, 2), (2, None, 4))
    assert run() == [(1, 13)]
    assert run() == [(1, 13)]
    arrive((2, 23, 3))
    arrive((2, 25, 5))
    assert run() == [(1, 13), (2, 25)]


def waiting_rows(tmp_path):
    n = iter(range(100))
    return WaitingRows(FileStore(f"{tmp_path}/w"), STREAM_EVENTS, lambda df: settled(df, f"{tmp_path}/held-{next(n)}"))


def keys(spark, *given):
    return spark.createDataFrame(list(given), "reference string, key int")


def test_rows_leave_with_the_last_key_they_wait_for(spark, tmp_path):
    waiting, known = waiting_rows(tmp_path), dimensions(spark, 3)
    batch = events(spark, [event(0), event(1, user=4), event(2, user=4, device=5), event(3, device=5), event(4, song=9)])
    assert waiting.file(batch, known, 0) == 4
    more = dimensions(spark, 4)
    out = waiting.release(spark, keys(spark, ("user_id", 4)), more, 1)
    assert rows(out, "event_id") == [("ev-1",)]
    more = dimensions(spark, 5)
    new = known_keys(more, STREAM_EVENTS.references).where("key = 5")
    assert rows(waiting.release(spark, new, more, 2), "event_id") == [("ev-2",), ("ev-3",)]
    # run again, a release gives the same
    assert rows(waiting.release(spark, new, more, 2), "event_id") == [("ev-2",), ("ev-3",)]
    assert waiting.release(spark, keys(spark, ("song_id", 8)), more, 3).count() == 0
    assert waiting.release(spark, keys(spark).limit(0), more, 4).count() == 0


def test_other_drawers_are_not_opened(spark, tmp_path):
    waiting, known = waiting_rows(tmp_path), dimensions(spark, 3)
    waiting.file(events(spark, [event(n, user=n) for n in range(4, 60)]), known, 0)
    (filed,) = (tmp_path / "w" / "waiting").rglob("waits_for=user_id")
    own = waiting.waiting_for(spark, keys(spark, ("user_id", 7)))
    assert rows(own, "event_id") == [("ev-7",)]
    drawer = spark.range(1).select(waiting._drawer(F.lit(7)).alias("d")).first().d
    for part in filed.glob("drawer=*/*.parquet"):
        if part.parent.name != f"drawer={drawer}":
            part.write_bytes(b"not to be read")
            (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert rows(waiting.waiting_for(spark, keys(spark, ("user_id", 7))), "event_id") == [("ev-7",)]
    other = next(n for n in range(4, 60) if spark.range(1).select(waiting._drawer(F.lit(n)).alias("d")).first().d != drawer)
    with pytest.raises(Exception):
        waiting.waiting_for(spark, keys(spark, ("user_id", other))).collect()


def test_a_delivery_files_what_it_rejects(spark, tmp_path):
    waiting, known = waiting_rows(tmp_path), {"n": 3}
    delivery = Delivery(waiting.store, lambda s: dimensions(s, known["n"]), waiting=waiting)
    batch = events(spark, [event(1), event(2, user=4), event(3, device=5, time=None)])
    delivery.deliver(batch, 0, STREAM_EVENTS)
    wanted = keys(spark, ("user_id", 4), ("device_id", 5))
    assert rows(waiting.waiting_for(spark, wanted), "event_id") == [("ev-2",)]
    known["n"] = 5
    delivery.deliver(batch, 0, STREAM_EVENTS)
    assert waiting.waiting_for(spark, wanted).count() == 0


def digest_trees(spark, tmp_path, given):
    """Stored events and metrics of them with their digests; the metrics of the 29th are wrong."""
    store = FileStore(str(tmp_path))
    raw, counted = digests.DigestTree(store, "events"), digests.DigestTree(store, "engagement")
    for batch, part in enumerate((given[::2], given[1::2])):
        store.write(events(spark, part), STREAM_EVENTS, batch)
        raw.add(digests.of_events(events(spark, part)), batch)
    right = metrics.windowed(events(spark, given), USER_ENGAGEMENT.name)
    wrong = F.expr("user_id = 2 AND to_date(time_window) = DATE'2024-01-29'")
    claimed = right.withColumn("stream_count", F.when(wrong, 7).otherwise(F.col("stream_count")))
    for batch, half in enumerate(("user_id % 2 = 0", "user_id % 2 = 1")):
        store.write(claimed.where(half), USER_ENGAGEMENT, batch)
        counted.add(digests.of_metrics(claimed.where(half)), batch)
    return store, raw, counted


GIVEN = [
    event(n, user=n % 3 or None, time=f"2024-01-{day} {9 + n % 3:02}:00:{n:02}")
    for day in (28, 29, 30)
    for n in range(1, 20)
]


def test_digests_lead_to_the_rows_that_differ(spark, tmp_path):
    store, raw, counted = digest_trees(spark, tmp_path, GIVEN)
    assert raw.unequal_days(spark, counted) == [date(2024, 1, 29)]
    minutes = raw.unequal_minutes(spark, counted, [date(2024, 1, 29)])
    found = rows(digests.differences(spark, store, STREAM_EVENTS, USER_ENGAGEMENT, raw, counted))
    assert found and {r[0] for r in found} == {r[0] for r in rows(minutes)}
    plain = Counter(
        (e["timestamp"].replace(second=0), e["user_id"]) for e in GIVEN if e["user_id"] == 2 and e["timestamp"].day == 29
    )
    assert found == sorted(((t, u, 7, n) for (t, u), n in plain.items()), key=str)


def test_equal_days_are_not_opened(spark, tmp_path):
    store, raw, counted = digest_trees(spark, tmp_path, GIVEN)
    for table in (STREAM_EVENTS, USER_ENGAGEMENT, raw.minutes, counted.minutes):
        for part in (tmp_path / table.name).glob("*/event_date=*/*.parquet"):
            if part.parent.name != "event_date=2024-01-29":
                part.write_bytes(b"not to be read")
                (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert digests.differences(spark, store, STREAM_EVENTS, USER_ENGAGEMENT, raw, counted).count() > 0
    with pytest.raises(Exception):
        store.read(spark, STREAM_EVENTS).agg(F.max("song_id")).collect()


def test_a_batch_of_digests_run_again_takes_its_own_place(spark, tmp_path):
    store = FileStore(str(tmp_path))
    raw, counted = digests.DigestTree(store, "events"), digests.DigestTree(store, "engagement")
    given = events(spark, GIVEN)
    for _ in range(2):
        raw.add(digests.of_events(given), 0)
    counted.add(digests.of_metrics(metrics.windowed(given, USER_ENGAGEMENT.name)), 0)
    assert raw.unequal_days(spark, counted) == []
    assert digests.differences(spark, store, STREAM_EVENTS, USER_ENGAGEMENT, raw, counted).count() == 0


def plays(spark, counts):
    """``counts``: per hour the number of plays of each song."""
    made, n = [], 0
    for hour, songs in enumerate(counts):
        for song, times in songs.items():
            for _ in range(times):
                n += 1
                made.append(event(n, song=song, time=f"2024-01-30 {hour:02}:10:00"))
    return events(spark, made)


def test_a_list_keeps_the_most_frequent_and_what_it_left_out(spark):
    lists = frequent.listed(plays(spark, [{1: 5, 2: 3, 3: 3, 4: 1}, {7: 2}]), "song_id", "1 hour", 2)
    assert rows(lists.drop("time_window")) == [(1, 1, 5, 5, 3), (1, 7, 2, 2, 0), (2, 2, 3, 3, 3)]


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_exact_counts_lie_within_bounds_after_any_merges(spark, size):
    counts = [{s: (s * 7 + h * 3) % 5 + (9 if s == 2 else 0) for s in range(1, 9)} for h in range(6)]
    lists = frequent.listed(plays(spark, counts), "song_id", "1 hour", size)
    exact = Counter()
    for songs in counts:
        exact.update(songs)
    for form in (lists, frequent.merged(lists, "2 hours", size), frequent.merged(frequent.merged(lists, "2 hours", size), "1 day", size)):
        best = frequent.top(form, 3).collect()
        assert all(r.low <= exact[r.item] <= r.high for r in best)
        sure = [r for r in best if r.certain]
        outside = max(n for s, n in exact.items() if s not in {r.item for r in best})
        assert all(exact[r.item] >= outside for r in sure)
        if size == 50:
            assert [(r.item, r.low) for r in best] == sorted(exact.items(), key=lambda p: (-p[1], p[0]))[:3]
            assert all(r.low == r.high for r in best)
    day = frequent.merged(lists, "1 day", size).collect()
    listed = {r.item: r for r in day}
    assert all(listed[s].low <= n <= listed[s].high if s in listed else n <= day[0].rest for s, n in exact.items())


def test_lists_of_nothing_are_empty(spark):
    none = plays(spark, [{}])
    lists = frequent.listed(none, "song_id", "1 hour")
    assert lists.count() == 0 and frequent.merged(lists, "1 day").count() == 0 and frequent.top(lists).count() == 0


def test_only_short_lists_are_sent(spark):
    plan = frequent.listed(plays(spark, [{1: 2}]), "song_id", "1 hour", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
