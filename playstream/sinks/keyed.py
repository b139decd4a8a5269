"""A table kept current from a changelog: small writes of changes, merged by size.

A batch of changes is reduced to the newest one per key and written as it is, whatever older changes of its keys are
stored: nothing is looked up and no row is rewritten. Readers take the newest change per key over all writes, so
batches may come in any order, and a batch that is run again takes its own place. ``compact`` merges writes of like size,
so that a change is rewritten about as often as the size of the table has digits to the base ``fan_in``.
A deleted key is a change like any other, until no older change of it can come any more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstream.model import Table
from playstream.operators.changelog import latest_per_key
from playstream.sinks.commits import Commit
from playstream.sinks.store import DIRECT, FileStore

ORDER, DELETED = "change_order", "deleted"


@dataclass(frozen=True)
class KeyedTable:
    """``table`` as the newest change of each primary key. Changes have the columns of the table, ``change_order``, by which
    the newest one is told and which no two changes of a key share, and ``deleted``; those without a key or an
    order are left out."""

    store: FileStore
    table: Table

    @property
    def changes(self) -> Table:
        """The stored table of changes."""
        more = [T.StructField(ORDER, T.LongType()), T.StructField(DELETED, T.BooleanType())]
        schema = T.StructType([*self.table.schema.fields, *more])
        return Table(f"{self.table.name}_changes", schema, self.table.primary_key)

    def _newest(self, changes: DataFrame) -> DataFrame:
        return latest_per_key(changes, self.table.primary_key, ORDER)

    def apply(self, changes: DataFrame, batch: int, run: str = DIRECT) -> None:
        """Store a batch of changes; run again, it takes the place of what it stored before."""
        usable = changes.select(*self.changes.columns).dropna(subset=[*self.table.primary_key, ORDER])
        self.store.write(self._newest(usable), self.changes, batch, run)

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows that hold now, one per key."""
        newest = self._newest(self.store.read(spark, self.changes))
        return newest.where(f"NOT coalesce({DELETED}, false)").select(*self.table.columns)

    def compact(self, spark: SparkSession, fan_in: int = 4, settled_before: int | None = None) -> Commit | None:
        """Merge the newest writes of like size into one; None if fewer than ``fan_in`` are like enough.

        A write is taken in while it is at most ``fan_in`` times as large as all later ones together. Deletes older than the
        order ``settled_before`` are dropped if the merge takes in every write, as nothing is left then that they
        hide; no older change may arrive later. Readers see the writes before or the merged one, never both.
        """
        now = self.store.commits(spark, self.changes)
        taken: list[Commit] = []
        held = 0
        for commit in reversed(now):
            if taken and commit.rows > fan_in * held:
                break
            taken.insert(0, commit)
            held += commit.rows
        if len(taken) < fan_in:
            return None
        newest = self._newest(self.store.rows_of(spark, self.changes, taken).select(*self.changes.columns))
        if settled_before is not None and len(taken) == len(now):
            newest = newest.where(f"NOT (coalesce({DELETED}, false) AND {ORDER} < {int(settled_before)})")
        return self.store.put_in_place_of(newest, self.changes, taken)
