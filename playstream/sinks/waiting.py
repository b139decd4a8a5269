"""Rejected rows filed by the key they wait for.

A row that points at unknown keys is filed under one of them, the first in the order of the table's references. When a
dimension gains keys, only the drawers of these keys are opened. Of what waits there, rows whose references are all known
by then are let go, and the others are filed under the next key they lack, so a row with several missing keys is
touched once for each and leaves with the last one. A key is new only once, as dimensions are insert-only; rows that
were let go or filed on are therefore not asked for again, and stay until their writes are removed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstream.model import Table
from playstream.operators.integrity import awaited, broken_keys, broken_sizes, valid, with_reasons
from playstream.sinks.store import DIRECT, FileStore

REFERENCE, DRAWER = "waits_for", "drawer"
Hold = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class WaitingRows:
    """``hold`` keeps what is used more than once, as by writing it to a table; ``drawers`` is how many parts each
    reference has, and does not change once rows are filed. A batch leaves up to one file in each drawer."""

    store: FileStore
    table: Table
    hold: Hold
    drawers: int = 16

    @property
    def filed(self) -> Table:
        own = [T.StructField("waits_for_key", T.LongType())]
        return Table(f"waiting/{self.table.name}", T.StructType([*self.table.schema.fields, *own]), self.table.primary_key)

    def _drawer(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key.cast("long")), F.lit(self.drawers)).cast("int")

    def file(self, rows: DataFrame, dimensions: Mapping[str, DataFrame], batch: int, run: str = DIRECT) -> int:
        """File those of ``rows`` that lack a key; a batch that is run again takes its own place. The number filed."""
        broken = self.hold(broken_keys(rows, dimensions, self.table.references))
        return self.file_lacking(rows, broken, broken_sizes(broken), batch, run)

    def file_lacking(
        self, rows: DataFrame, broken: DataFrame, sizes: Mapping[str, int], batch: int, run: str = DIRECT
    ) -> int:
        """The same where the ``broken`` keys are known already, and how many there are of each reference."""
        if not any(sizes.values()):
            self.store.withdraw(rows.sparkSession, self.filed, batch, run)
            return 0
        lacking = awaited(rows.select(*self.table.columns), broken, self.table.references, sizes)
        placed = lacking.select(
            *self.table.columns,
            F.col("_key").alias("waits_for_key"),
            F.col("_reference").alias(REFERENCE),
            self._drawer(F.col("_key")).alias(DRAWER),
        )
        return self.store.write_nested(placed, self.filed, (REFERENCE, DRAWER), batch, run)

    def waiting_for(self, spark: SparkSession, keys: DataFrame) -> DataFrame:
        """Rows filed under ``keys`` (``reference, key``, as ``known_keys`` gives them). Other drawers are not opened."""
        sited = keys.where("key IS NOT NULL").select("reference", F.col("key").cast("long").alias("waits_for_key"))
        opened = sited.select("reference", self._drawer(F.col("waits_for_key")).alias(DRAWER)).distinct().collect()
        names = sorted({r.reference for r in opened})
        drawers = [
            (F.col(REFERENCE) == name) & F.col(DRAWER).isin([r[DRAWER] for r in opened if r.reference == name])
            for name in names
        ]
        within = reduce(Column.__or__, drawers, F.lit(False))
        rows = self.store.read_nested(spark, self.filed, (REFERENCE, DRAWER)).where(within)
        waited = sited.withColumnRenamed("reference", REFERENCE).distinct()
        return rows.join(waited, [REFERENCE, "waits_for_key"], "left_semi").select(*self.table.columns)

    def release(
        self, spark: SparkSession, keys: DataFrame, dimensions: Mapping[str, DataFrame], batch: int, run: str = DIRECT
    ) -> DataFrame:
        """Rows that waited for ``keys`` and lack none any more, each once; those that lack another are filed under it,
        as ``batch``. ``dimensions`` hold the new keys already."""
        found = self.hold(self.waiting_for(spark, keys).dropDuplicates(list(self.table.primary_key)))
        broken = self.hold(broken_keys(found, dimensions, self.table.references))
        sizes = broken_sizes(broken)
        self.file_lacking(found, broken, sizes, batch, run)
        return valid(with_reasons(found, self.table, broken, sizes)).select(*self.table.columns)
