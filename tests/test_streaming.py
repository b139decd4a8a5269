import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from playstream.model import STREAM_EVENTS, TABLES, USER_ENGAGEMENT
from playstream.operators.parsing import to_wire
from playstream.plans import catalog, metrics
from playstream.session import streaming_session
from playstream.sinks import outlets
from playstream.sinks.store import FileStore
from playstream.sources import bus
from playstream.streaming import job
from playstream.streaming.delivery import Delivery
from tests.helpers import dimensions, event, events, rows

AT = datetime(2024, 1, 31)
DRAIN = job.Schedule(drain=True)


@pytest.fixture(scope="module")
def streams(spark):
    return streaming_session(spark, state_partitions=2)


def write_file(spark, folder, name, *items):
    """One file of messages; items are event dicts or raw text."""
    lines = []
    for item in items:
        if isinstance(item, dict):
            row = events(spark, [item])
            item = row.select(to_wire(row).alias("value")).first().value
        lines.append(item)
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(streams, folder, store, checkpoints, tables, delivery=None, per_batch=1):
    delivery = delivery or Delivery(store, dimensions=dimensions, clock=lambda: AT)
    source = bus.message_files_stream(streams, str(folder), files_per_batch=per_batch)
    running = job.start_all(source, delivery, str(checkpoints), DRAIN, tables=tables)
    job.await_all(running.values())
    return running


def test_a_late_row_is_dropped_from_metrics_and_kept_raw(streams, tmp_path):
    inbox, store = tmp_path / "in", FileStore(str(tmp_path / "store"))
    # A batch drops rows behind the watermark that the batch before it started with.
    write_file(streams, inbox, "1.json", event(1, time="2024-01-01 00:00:10"), event(2, time="2024-01-01 00:20:00"))
    write_file(streams, inbox, "2.json", event(3, time="2024-01-01 00:21:00"))
    write_file(streams, inbox, "3.json", event(4, time="2024-01-01 00:00:20"))
    write_file(streams, inbox, "4.json", event(5, time="2024-01-01 00:40:00"))
    running = run(
        streams, inbox, store, tmp_path / "cp", ["stream_events", "user_engagement_metrics"]
    )
    got = rows(store.read(streams, USER_ENGAGEMENT), "time_window", "stream_count")
    assert got == [(datetime(2024, 1, 1, 0, minute), 1) for minute in (0, 20, 21)]
    assert store.read(streams, STREAM_EVENTS).count() == 5
    progress = running["user_engagement_metrics"].recentProgress
    assert sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators) == 1


def test_bad_rows_become_dead_letters_and_restart_adds_nothing(streams, tmp_path):
    inbox, store = tmp_path / "in", FileStore(str(tmp_path / "store"))
    bad_keys = [event(2, user=901), event(3, user=902)]
    write_file(streams, inbox, "1.json", event(1), *bad_keys, event(4, user=None), "{bad", event(5, time=None))
    run(streams, inbox, store, tmp_path / "cp", ["stream_events"])
    for _ in range(2):  # the second run finds nothing new
        assert rows(store.read(streams, STREAM_EVENTS), "event_id") == [("ev-1",), ("ev-4",)]
        letters = [json.loads(r.value) for r in store.read_dead_letters(streams, "stream_events").collect()]
        why = sorted(json.loads(x["error_info"])["error_message"] for x in letters)
        assert why == [
            "Foreign key violation: user_id=901",
            "Foreign key violation: user_id=902",
            "Malformed record",
            "Missing required value: timestamp",
        ]
        assert [x["_corrupt_record"] for x in letters if "_corrupt_record" in x] == ["{bad"]
        run(streams, inbox, store, tmp_path / "cp", ["stream_events"])
    write_file(streams, inbox, "2.json", event(6))
    run(streams, inbox, store, tmp_path / "cp", ["stream_events"])
    assert store.read(streams, STREAM_EVENTS).count() == 3


def test_landed_events_give_the_same_tables(streams, tmp_path):
    inbox = tmp_path / "in"
    write_file(streams, inbox, "1.json", event(1, time="2024-01-01 00:00:10"), "{bad", event(2, user=901))
    write_file(streams, inbox, "2.json", event(3, time="2024-01-01 01:00:00.123456", is_liked=True))
    direct, landed = FileStore(str(tmp_path / "a")), FileStore(str(tmp_path / "b"))
    tables = ["stream_events", "user_engagement_metrics"]
    run(streams, inbox, direct, tmp_path / "cpa", tables)
    folder = str(tmp_path / "landing")
    source = bus.message_files_stream(streams, str(inbox))
    job.start_landing(source, folder, str(tmp_path / "cpb"), DRAIN).awaitTermination()
    delivery = Delivery(landed, dimensions=dimensions, clock=lambda: AT)
    parsed = job.landed_events(streams, folder, files_per_batch=1)
    job.await_all(job.start_parsed(parsed, delivery, str(tmp_path / "cpb"), DRAIN, tables=tables).values())
    for name in tables:
        assert rows(landed.read(streams, TABLES[name])) == rows(direct.read(streams, TABLES[name]))
    assert landed.read_dead_letters(streams, "stream_events").count() == 2


class Box:
    def __init__(self):
        self.seen = []

    def write_dead_letters(self, letters, table, batch, run):
        self.seen += [(table, batch, r.value) for r in letters.collect()]


def test_dead_letters_can_go_elsewhere(spark, tmp_path):
    box = Box()
    delivery = Delivery(FileStore(str(tmp_path)), dimensions, letters=box)
    delivery.deliver(events(spark, [event(1, song=44), event(2)]), 3, STREAM_EVENTS)
    assert [(table, batch) for table, batch, _ in box.seen] == [("stream_events", 3)]


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    store = FileStore(str(tmp_path))
    delivery = Delivery(store, dimensions=dimensions, clock=lambda: AT)
    batch = events(spark, [event(1), event(1), event(2, time="2024-01-29 10:00:00"), event(3, device=99)])
    for _ in range(2):
        delivery.deliver(batch, 5, STREAM_EVENTS)
    delivery.deliver(events(spark, [event(4)]), 6, STREAM_EVENTS)
    assert rows(store.read(spark, STREAM_EVENTS), "event_id") == [("ev-1",), ("ev-2",), ("ev-4",)]
    assert store.read_dead_letters(spark, "stream_events").count() == 1
    recent = store.read(spark, STREAM_EVENTS, since=datetime(2024, 1, 30, 0, 0))
    assert rows(recent, "event_id") == [("ev-1",), ("ev-4",)]
    one_day = store.read_period(spark, STREAM_EVENTS, "2024-01-29", "2024-01-29")
    assert rows(one_day, "event_id") == [("ev-2",)]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_a_new_checkpoint_leaves_older_batches_alone(streams, tmp_path):
    store = FileStore(str(tmp_path / "store"))
    for nth, name in enumerate(("a", "b")):
        write_file(streams, tmp_path / name, "1.json", event(1), event(2 + nth), event(7, user=901))
        run(streams, tmp_path / name, store, tmp_path / f"cp-{name}", ["stream_events"])
    assert rows(store.read(streams, STREAM_EVENTS), "event_id") == [("ev-1",), ("ev-2",), ("ev-3",)]
    assert store.read_dead_letters(streams, "stream_events").count() == 2


def test_an_event_that_comes_again_in_a_later_batch_is_stored_once(spark, tmp_path):
    store = FileStore(str(tmp_path))
    delivery = Delivery(store, dimensions)
    delivery.deliver(events(spark, [event(1), event(2)]), 0, STREAM_EVENTS)
    for _ in range(2):
        delivery.deliver(events(spark, [event(2), event(3)]), 1, STREAM_EVENTS)
    assert rows(store.read(spark, STREAM_EVENTS), "event_id") == [("ev-1",), ("ev-2",), ("ev-3",)]


def test_files_follow_rows_and_not_tasks(spark, tmp_path):
    store = FileStore(str(tmp_path), rows_per_file=1000)
    Delivery(store).deliver(events(spark, [event(n) for n in range(400)]).repartition(200), 0, STREAM_EVENTS)
    assert len(list((tmp_path / "stream_events").rglob("part-*.parquet"))) == 1
    assert store.read(spark, STREAM_EVENTS).count() == 400


class BrokenStore(FileStore):
    def write(self, rows, table, batch, run="", count=None):
        raise OSError("store is down")


def test_a_failing_store_stops_or_diverts(spark, tmp_path):
    batch = events(spark, [event(1), event(2), event(3, user=901)])
    with pytest.raises(OSError):
        Delivery(BrokenStore(str(tmp_path)), dimensions).deliver(batch, 0, STREAM_EVENTS)
    store = BrokenStore(str(tmp_path))
    Delivery(store, dimensions, on_error="dead-letter", clock=lambda: AT).deliver(batch, 0, STREAM_EVENTS)
    letters = [json.loads(r.value) for r in store.read_dead_letters(spark, "stream_events_unstored").collect()]
    assert {x["event_id"] for x in letters} == {"ev-1", "ev-2"}
    assert store.read_dead_letters(spark, "stream_events").count() == 1
    assert json.loads(letters[0]["error_info"])["error_message"] == "store is down"
    with pytest.raises(ValueError):
        Delivery(store, on_error="ignore")


def test_dimensions_are_read_anew_for_every_batch(spark, tmp_path):
    size = {"n": 1}
    store = FileStore(str(tmp_path))
    delivery = Delivery(store, dimensions=lambda s: dimensions(s, size["n"]))
    delivery.deliver(events(spark, [event(1, song=2)]), 0, STREAM_EVENTS)
    size["n"] = 2
    delivery.deliver(events(spark, [event(2, song=2)]), 1, STREAM_EVENTS)
    assert rows(store.read(spark, STREAM_EVENTS), "event_id") == [("ev-2",)]


def test_closed_windows_of_the_stream_equal_the_batch(spark, star):
    streamed = catalog.queries()["stream_hourly"](spark, star.folder)
    exact = metrics.windowed(star.stream_events, "hourly_metrics")
    last = star.stream_events.agg(F.max("timestamp")).first()[0]
    final_watermark = F.lit(str(last)).cast("timestamp_ntz") - F.expr("INTERVAL 2 MINUTES")
    closed = exact.where(F.col("time_window") + F.expr("INTERVAL 1 HOUR") <= final_watermark)
    same = [c for c in TABLES["hourly_metrics"].columns if not c.startswith("unique_")]
    assert streamed.where("NOT (unique_users_within_error AND unique_artists_within_error)").count() == 0
    assert rows(streamed, *same) == rows(closed, *same)


def test_messages_pass_through_as_text(streams, tmp_path):
    inbox = tmp_path / "in"
    write_file(streams, inbox, "1.json", "hello", "there")
    source = bus.as_text(bus.message_files_stream(streams, str(inbox)))
    query = source.writeStream.format("memory").queryName("passed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(streams.table("passed")) == [("hello",), ("there",)]
    printed = outlets.console(source).trigger(availableNow=True).start()
    printed.awaitTermination()
    assert printed.exception() is None


def test_running_queries_are_listed(streams, tmp_path):
    inbox = tmp_path / "in"
    write_file(streams, inbox, "1.json", event(1))
    source = bus.message_files_stream(streams, str(inbox))
    delivery = Delivery(FileStore(str(tmp_path / "store")), dimensions)
    running = job.start_all(
        source, delivery, str(tmp_path / "cp"), job.Schedule(every="1 second"), tables=["stream_events"]
    )
    assert [name for _, name in job.active_queries(streams)] == ["stream_events"]
    for query in running.values():
        query.processAllAvailable()
        query.stop()
    assert job.active_queries(streams) == []
