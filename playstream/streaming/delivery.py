"""Delivery of one micro-batch: check, store what is valid, keep the rest."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.model import Table
from playstream.operators.deadletter import to_dead_letters
from playstream.operators.integrity import broken_keys, broken_sizes, invalid, valid, with_reasons
from playstream.operators.parsing import CORRUPT
from playstream.sinks.outlets import period, unseen_rows
from playstream.sinks.store import DIRECT
from playstream.sinks.waiting import WaitingRows


class RowStore(Protocol):
    """Holds tables. Writing one batch twice must leave it stored once."""

    def write(self, rows: DataFrame, table: Table, batch: int, run: str, count: int | None = None) -> None: ...


class LetterBox(Protocol):
    """Takes dead letters: rows with one ``value`` of text."""

    def write_dead_letters(self, letters: DataFrame, table: str, batch: int, run: str) -> None: ...


Dimensions = Callable[[SparkSession], dict[str, DataFrame]]


def run_of(spark: SparkSession) -> str:
    """Id of the streaming query whose batch is being handled, which its checkpoint keeps."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or DIRECT


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Delivery:
    """Settings of a delivery.

    ``letters`` takes the dead letters, by default the store itself.
    ``dimensions`` is asked anew for every batch, so rows added to a dimension
    count from the next batch on. ``on_error`` says what happens when the store
    itself fails: ``fail`` stops the query, which retries the batch on restart;
    ``dead-letter`` keeps the whole batch as dead letters and goes on. ``waiting``
    also files readable rows by the key they lack, for a later load to release.
    """

    store: RowStore
    dimensions: Dimensions | None = None
    letters: LetterBox | None = None
    on_error: str = "fail"
    waiting: WaitingRows | None = None
    clock: Callable[[], datetime] = field(default=_now)

    def __post_init__(self):
        if self.on_error not in ("fail", "dead-letter"):
            raise ValueError(f"on_error: {self.on_error}")

    @property
    def _letters(self) -> LetterBox:
        return self.letters or self.store

    def __call__(self, table: Table) -> Callable[[DataFrame, int], None]:
        return lambda rows, batch: self.deliver(rows, batch, table)

    def deliver(self, rows: DataFrame, batch: int, table: Table) -> None:
        """Store one batch. Running it again replaces what it wrote before, and only that.

        Counting fills the cache and commits the state of every partition. Most
        batches of a metric close no window and end there.
        """
        kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            count = kept.count()
            if count:
                self._check_and_write(kept, batch, table, run_of(rows.sparkSession), count)
        finally:
            kept.unpersist()

    def _check_and_write(self, rows: DataFrame, batch: int, table: Table, run: str, count: int) -> None:
        broken, sizes = None, None
        if self.dimensions and table.references:
            broken = broken_keys(rows, self.dimensions(rows.sparkSession), table.references)
            broken = broken.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if broken is not None:
                sizes = broken_sizes(broken)
            checked = with_reasons(rows, table, broken, sizes)
            self._store(valid(checked), batch, table, run, count)
            rejected = invalid(checked)
            letters = to_dead_letters(rejected, table.name, batch, self.clock())
            if not rejected.isEmpty():
                self._letters.write_dead_letters(letters, table.name, batch, run)
            elif hasattr(self._letters, "withdraw_dead_letters"):
                self._letters.withdraw_dead_letters(rows.sparkSession, table.name, batch, run)
            if self.waiting and self.waiting.table == table:
                self._file(rejected, broken, sizes, batch, table, run)
        finally:
            if broken is not None:
                broken.unpersist()

    def _file(
        self, rejected: DataFrame, broken: DataFrame | None, sizes: dict[str, int] | None, batch: int, table: Table, run: str
    ) -> None:
        readable = rejected.where(F.col(CORRUPT).isNull()) if CORRUPT in rejected.columns else rejected
        complete = readable.dropna(subset=list(table.required)) if table.required else readable
        self.waiting.file_lacking(complete, broken, sizes or {}, batch, run)

    def _store(self, accepted: DataFrame, batch: int, table: Table, run: str, count: int) -> None:
        """A primary key is stored once: a producer's retry may repeat it inside a batch, or in a later one."""
        unique = accepted.dropDuplicates(list(table.primary_key)) if table.required else accepted
        if table.partition_date and hasattr(self.store, "stored_keys"):
            unique = self._not_stored_yet(unique, batch, table, run)
        try:
            self.store.write(unique, table, batch, run, count)
        except Exception as error:
            if self.on_error == "fail":
                raise
            letters = to_dead_letters(accepted, table.name, batch, self.clock(), message=str(error))
            self._letters.write_dead_letters(letters, f"{table.name}_unstored", batch, run)

    def _not_stored_yet(self, rows: DataFrame, batch: int, table: Table, run: str) -> DataFrame:
        """Rows whose key no other batch has stored. Keys are read only of writes that hold times of the batch and
        whose key filter has one of its keys."""
        span = period(rows, table.partition_date)
        stored = None if span is None else self.store.stored_keys(rows, table, *span, batch, run)
        return rows if stored is None else unseen_rows(rows, stored, table)
