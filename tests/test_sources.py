import pytest

from playstream.session import run_folder, shared_folder, streaming_session
from playstream.sinks import outlets
from playstream.sources import bus, tables
from playstream.sources.tables import Connection, Split
from playstream.model import STREAM_EVENTS, USER_ENGAGEMENT
from playstream.plans import metrics
from tests.helpers import event, events, rows


def test_bus_read_options():
    assert bus.kafka_options("b:9092", "plays") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "plays",
        "startingOffsets": "earliest",
    }
    bounded = bus.kafka_options("b:9092", "users", ending="latest", min_partitions=64, max_per_batch=1000)
    assert bounded["endingOffsets"] == "latest"
    assert bounded["minPartitions"] == "64" and bounded["maxOffsetsPerTrigger"] == "1000"


def test_bus_write_options():
    assert outlets.bus_options("b:9092", "dead-letter-queue") == {
        "kafka.bootstrap.servers": "b:9092",
        "topic": "dead-letter-queue",
    }


def test_relational_options():
    connection = Connection("jdbc:x:y", "x.Driver", "me", extra=(outlets.TEXT_AS_UUID,))
    assert connection.properties() == {"driver": "x.Driver", "user": "me", "stringtype": "unspecified"}
    assert tables.scan_options("t") == {"dbtable": "t", "fetchsize": "10000", "preferTimestampNTZ": "true"}
    split = tables.scan_options("t", Split("id", "0", "100", 8))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    assert outlets.write_options("t", max_connections=4)["numPartitions"] == "4"


def test_message_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n{"a":2}\n')
    got = bus.message_files_batch(spark, str(tmp_path))
    assert got.columns == ["key", "value"]
    assert rows(bus.as_text(got)) == [('{"a":1}',), ('{"a":2}',)]


def test_views_serve_sql_text(star):
    tables.register_views(star.dimensions() | {"stream_events": star.stream_events})
    got = star.spark.sql(
        "SELECT d.os, count(*) AS n FROM stream_events e JOIN devices d ON e.device_id = d.device_id GROUP BY d.os"
    )
    assert got.count() == 5


def test_rows_a_store_has_already_are_recognised(spark):
    stored = events(spark, [event(1), event(2)])
    again = events(spark, [event(2), event(3)])
    assert rows(outlets.unseen_rows(again, stored, STREAM_EVENTS), "event_id") == [("ev-3",)]
    metric = metrics.windowed(events(spark, [event(1, user=None)]), USER_ENGAGEMENT.name)
    assert outlets.unseen_rows(metric, metric, USER_ENGAGEMENT).count() == 0  # NULL keys match
    assert outlets.unseen_rows(again.limit(0), stored, STREAM_EVENTS).count() == 0


class Kept(outlets.RelationalStore):
    """The appended rows in memory in place of a database."""

    def __init__(self, spark):
        super().__init__(Connection("jdbc:none", "none"))
        self.rows = events(spark, [])

    def read(self, spark, table, other_than_batch=None, since=None):
        return self.rows

    def _append(self, rows, table):
        self.rows = self.rows.unionByName(rows)


def test_a_repeated_relational_write_adds_only_what_is_missing(spark):
    store = Kept(spark)
    store.write(events(spark, [event(1), event(2)]), STREAM_EVENTS, 0)
    store.write(events(spark, [event(2), event(3)]), STREAM_EVENTS, 0)
    store.write(events(spark, []), STREAM_EVENTS, 1)
    assert rows(store.rows, "event_id") == [("ev-1",), ("ev-2",), ("ev-3",)]


def test_working_folder(spark):
    assert run_folder(spark, "x") != run_folder(spark, "x")
    assert run_folder(spark, "x").startswith(shared_folder(spark))


class Cluster:
    class sparkContext:
        master = "spark://somewhere"

    class conf:
        @staticmethod
        def get(name, default=None):
            return default


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError):
        shared_folder(Cluster)


def test_streaming_settings_do_not_leak(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sibling = streaming_session(spark, 3)
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
