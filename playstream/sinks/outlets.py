"""Relational, message-bus and console outlets."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.functions.timeparts import moment
from playstream.model import Table
from playstream.sources.tables import Connection, Split, relational_scan

# Lets a store with a native UUID column accept the text form.
TEXT_AS_UUID = ("stringtype", "unspecified")


def write_options(table: str, batch_size: int = 10_000, max_connections: int | None = None) -> dict[str, str]:
    options = {"dbtable": table, "batchsize": str(batch_size)}
    if max_connections:
        options["numPartitions"] = str(max_connections)
    return options


def relational_append(
    rows: DataFrame, connection: Connection, table: str, batch_size: int = 10_000, max_connections: int | None = None
) -> None:
    """Append rows; ``max_connections`` bounds how many tasks write at a time."""
    (
        rows.write.format("jdbc")
        .mode("append")
        .option("url", connection.url)
        .options(**connection.properties())
        .options(**write_options(table, batch_size, max_connections))
        .save()
    )


def bus_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def bus_append(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``value`` (and ``key`` if there is one) to a topic."""
    columns = [F.col(c).cast("string") for c in ("key", "value") if c in messages.columns]
    messages.select(*columns).write.format("kafka").options(**bus_options(servers, topic)).save()


def unseen_rows(rows: DataFrame, stored: DataFrame, table: Table) -> DataFrame:
    """Rows not yet in a store that only appends, for replays.

    NULL keys count as equal. ``stored`` should be limited to the period of
    ``rows`` already; see ``period``.
    """
    keys = list(table.primary_key)
    slim = stored.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
    matches = [F.col(k).eqNullSafe(F.col(f"_stored_{k}")) for k in keys]
    return rows.join(slim, reduce(Column.__and__, matches), "left_anti")


def period(rows: DataFrame, column: str) -> tuple | None:
    """First and last time in the rows, or None without rows."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    return None if low is None else (low, high)


class RelationalStore:
    """Tables in a relational store, which only appends.

    A write that was cut short leaves some rows behind, so a batch first leaves
    out what is stored already, looking only at the batch's own period.
    ``splits`` lets large tables be read in parallel.
    """

    def __init__(
        self,
        connection: Connection,
        splits: Mapping[str, Split] | None = None,
        max_connections: int | None = None,
    ):
        self.connection = connection
        self.splits = dict(splits or {})
        self.max_connections = max_connections

    def read(
        self,
        spark: SparkSession,
        table: Table,
        other_than_batch: int | None = None,
        since: datetime | None = None,
        run: str = "",
    ) -> DataFrame:
        """Rows of a table; batches are not told apart here."""
        rows = relational_scan(spark, self.connection, table.name, self.splits.get(table.name))
        if since is not None:
            rows = rows.where(F.col(table.partition_date) >= moment(since))
        return rows

    def write(self, rows: DataFrame, table: Table, batch: int, run: str = "", count: int | None = None) -> None:
        """Runs and batches are not told apart: what is stored by key already is left out."""
        shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        stored = self.read(rows.sparkSession, table)
        if table.partition_date:
            span = period(shaped, table.partition_date)
            if span is None:
                return
            stored = stored.where(F.col(table.partition_date).between(*map(moment, span)))
        self._append(unseen_rows(shaped, stored, table), table)

    def _append(self, rows: DataFrame, table: Table) -> None:
        relational_append(rows, self.connection, table.name, max_connections=self.max_connections)


class BusLetters:
    """Dead letters as messages of one topic.

    The key names table, run, batch and content, so a batch that is retried sends equal
    messages under equal keys, which compaction of the topic or its reader removes.
    """

    def __init__(self, servers: str, topic: str = "dead-letter-queue"):
        self.servers = servers
        self.topic = topic

    def write_dead_letters(self, letters: DataFrame, table: str, batch: int, run: str = "") -> None:
        name = F.concat_ws("/", F.lit(table), F.lit(run), F.lit(str(batch)), F.xxhash64("value").cast("string"))
        bus_append(letters.withColumn("key", name), self.servers, self.topic)


def console(stream: DataFrame):
    """Print a stream as it arrives; start the returned writer to run it."""
    return stream.writeStream.outputMode("append").format("console").option("truncate", "false")
