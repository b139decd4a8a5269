"""Streaming queries: five windowed metric tables and the raw events."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from playstream.model import METRIC_TABLES, STREAM_EVENTS, TABLES, USER_SESSIONS
from playstream.operators.parsing import CORRUPT, parse_events, readable
from playstream.operators.sessions import session_stream
from playstream.plans.additive import ADDITIVE, additive
from playstream.plans.metrics import windowed
from playstream.sinks.keyed import KeyedTable
from playstream.sinks.store import FileStore
from playstream.streaming.delivery import Delivery, run_of

LATENESS = "2 minutes"
RAW = STREAM_EVENTS.name


@dataclass(frozen=True)
class Schedule:
    """When batches run. ``drain`` handles all that is there and stops;
    ``every`` is an interval; neither means as soon as the last one is done."""

    drain: bool = False
    every: str | None = None

    def apply(self, writer):
        if self.drain:
            return writer.trigger(availableNow=True)
        if self.every:
            return writer.trigger(processingTime=self.every)
        return writer


def with_lateness(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return events.withWatermark("timestamp", lateness)


def metric_stream(events: DataFrame, table: str, lateness: str = LATENESS) -> DataFrame:
    """Windows of one metric; each is emitted once, after the watermark passes it.

    Distinct counts are sketches here: their state is bounded per window.
    """
    if table == USER_SESSIONS.name:
        return session_stream(with_lateness(events, lateness))
    if table in ADDITIVE:
        return additive(with_lateness(events, lateness), table)
    return windowed(with_lateness(events, lateness), table, exact_distinct=False)


def without_repeats(parsed: DataFrame, within: str) -> DataFrame:
    """Events whose id came in the last ``within`` already are left out, whatever batch they came in.

    The time that counts is that of arrival, so no event is late here. Rows without an id, such as corrupt ones, all
    stay. State is bounded by the events of ``within``.
    """
    own = F.when(F.col("event_id").isNull(), F.uuid()).otherwise(F.col("event_id"))
    arrived = parsed.withColumn("_arrived", F.current_timestamp()).withColumn("_own", own)
    return arrived.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_own"]).drop("_arrived", "_own")


def start_sums(
    parsed: DataFrame,
    table: str,
    store: FileStore,
    checkpoints: str,
    schedule: Schedule = Schedule(),
) -> StreamingQuery:
    """Store what each batch adds to the windows of an additive table, without a watermark.

    No event comes too late: it corrects its window by one more row. A batch that is run again replaces its rows.
    """

    def add(rows: DataFrame, batch: int) -> None:
        store.write(additive(rows, table), TABLES[table], batch, run_of(rows.sparkSession))

    writer = (
        readable(parsed)
        .writeStream.queryName(f"{table}-added")
        .foreachBatch(add)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{table}-added")
    )
    return schedule.apply(writer).start()


def start_changelog(
    changes: DataFrame,
    keyed: KeyedTable,
    checkpoints: str,
    schedule: Schedule = Schedule(),
    fan_in: int = 4,
    settled_before: Callable[[SparkSession], int | None] = lambda spark: None,
) -> StreamingQuery:
    """Keep a table current from a stream of its changes, in whatever order they come.

    Writes of like size are merged after each batch. ``settled_before`` is asked then for the order before which no
    change is to come any more; without one, deletes are kept for good.
    """

    def add(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        keyed.apply(rows, batch, run_of(spark))
        keyed.compact(spark, fan_in, settled_before(spark))

    writer = (
        changes.writeStream.queryName(f"{keyed.table.name}-changes")
        .foreachBatch(add)
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{keyed.table.name}-changes")
    )
    return schedule.apply(writer).start()


def start(
    rows: DataFrame, table: str, delivery: Delivery, checkpoints: str, schedule: Schedule = Schedule()
) -> StreamingQuery:
    """Run one query with its own checkpoint, delivering to ``table``."""
    writer = (
        rows.writeStream.queryName(table)
        .foreachBatch(delivery(TABLES[table]))
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/{table}")
    )
    return schedule.apply(writer).start()


def start_landing(
    messages: DataFrame, folder: str, checkpoints: str, schedule: Schedule = Schedule()
) -> StreamingQuery:
    """Parse the bus once and land the result as Parquet, each message exactly once.

    Spark's file sink records which files belong to finished batches, and streams
    over the folder read only those. Six queries then share one parse and each
    reads only the columns it needs.
    """
    writer = (
        parse_events(messages)
        .writeStream.queryName("landing")
        .format("parquet")
        .option("path", folder)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints.rstrip('/')}/landing")
    )
    return schedule.apply(writer).start()


def landed_events(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over a landing folder; takes the place of parsed messages."""
    fields = STREAM_EVENTS.schema.fields
    as_parsed = [
        T.StructField(f.name, T.TimestampType()) if isinstance(f.dataType, T.TimestampNTZType) else f for f in fields
    ]
    reader = spark.readStream.schema(T.StructType([*as_parsed, T.StructField(CORRUPT, T.StringType())]))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def start_all(
    messages: DataFrame,
    delivery: Delivery,
    checkpoints: str,
    schedule: Schedule = Schedule(),
    lateness: str = LATENESS,
    tables: Iterable[str] = (RAW, *(t.name for t in METRIC_TABLES)),
    repeats_within: str | None = None,
) -> dict[str, StreamingQuery]:
    """Start the raw copy and the metrics over one message source."""
    return start_parsed(parse_events(messages), delivery, checkpoints, schedule, lateness, tables, repeats_within)


def start_parsed(
    parsed: DataFrame,
    delivery: Delivery,
    checkpoints: str,
    schedule: Schedule = Schedule(),
    lateness: str = LATENESS,
    tables: Iterable[str] = (RAW, *(t.name for t in METRIC_TABLES)),
    repeats_within: str | None = None,
) -> dict[str, StreamingQuery]:
    """The same over parsed events, such as landed ones.

    Raw rows have no watermark of their time: late ones are stored and corrupt ones become dead
    letters. Metrics take readable rows only. With ``repeats_within`` the raw copy drops events that
    a producer sends again within that time before they are compared with the store.
    """
    running = {}
    raw = without_repeats(parsed, repeats_within) if repeats_within else parsed
    for table in tables:
        rows = raw if table == RAW else metric_stream(readable(parsed), table, lateness)
        running[table] = start(rows, table, delivery, checkpoints, schedule)
    return running


def active_queries(spark: SparkSession) -> list[tuple[str, str]]:
    return [(str(q.id), q.name) for q in spark.streams.active]


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait until every query has ended; a failure is raised when it happens, whichever query has it."""
    pending = list(queries)
    while pending:
        pending = [query for query in pending if not query.awaitTermination(0.2)]


def await_any(spark: SparkSession) -> None:
    """Wait until some query ends, as a long-running service does."""
    spark.streams.awaitAnyTermination()
