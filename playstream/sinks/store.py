"""Where tables and dead letters are written.

Each write goes to a folder of its own, nested by date inside, and counts from the moment its entry is in the
table's log (``commits``). A batch that is run again takes the place of what it wrote before, whole, so neither a failure
nor a changed dimension leaves rows behind. ``run`` names whoever numbers the batches, as a streaming query does by the
id in its checkpoint: another run's batches of the same number are left alone. Time filters skip whole writes and dates.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstream.functions.timeparts import moment
from playstream.model import Table
from playstream.sinks import keyfilter
from playstream.sinks.commits import Commit, CommitLog, live, next_number

FOLDER = "folder"
DATE = "event_date"
DIRECT = "direct"
LETTERS = "dead_letters"
VALUE = T.StructType([T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class KeyCheck:
    """How many stored writes a batch was compared with: those of its period, and those whose keys had to be read."""

    in_period: int
    opened: int


class FileStore:
    """``rows_per_file`` sets how many files a batch leaves: its rows are dealt by
    date and a salt over that many tasks, however many tasks brought them."""

    def __init__(self, root: str, rows_per_file: int = 2_000_000):
        self.root = root.rstrip("/")
        self.rows_per_file = rows_per_file
        self.last_check: KeyCheck | None = None

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, name: str) -> CommitLog:
        return CommitLog(f"{self.root}/_commits/{name}")

    def write(self, rows: DataFrame, table: Table, batch: int, run: str = DIRECT, count: int | None = None) -> None:
        """Store a batch in place of what it stored before. ``count`` is its number of rows, where it is known."""
        self._write(rows, table, run, batch, (), count)

    def _write(
        self, rows: DataFrame, table: Table, run: str, batch: int, replaces: tuple[int, ...], count: int | None
    ) -> Commit:
        spark = rows.sparkSession
        placed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
        when = table.partition_date
        if when:
            placed = placed.withColumn(DATE, F.to_date(when))
        if count is not None:
            files = -(-count // self.rows_per_file) or 1
            salt = F.pmod(F.xxhash64(*table.primary_key), F.lit(files))
            placed = placed.repartition(files, *([DATE] if when else []), salt)
        elif when:
            placed = placed.hint("rebalance", F.col(DATE))
        folder, seen = f"w{uuid.uuid4().hex}", Observation()
        bounds = [F.min(when).alias("low"), F.max(when).alias("high")] if when else []
        writer = placed.observe(seen, F.count(F.lit(1)).alias("rows"), *bounds).write
        path = f"{self._path(table.name)}/{FOLDER}={folder}"
        (writer.partitionBy(DATE) if when else writer).parquet(path)
        found = seen.get
        key_bits = 0
        if when and found["rows"]:
            key_bits = keyfilter.bits_for(found["rows"])
            stored = spark.read.schema(table.schema).parquet(path).select(*table.primary_key)
            filters = keyfilter.built(stored, table.primary_key, key_bits)
            filters.coalesce(1 + key_bits // keyfilter.BITS_PER_FILE).write.parquet(self._filter_path(table, folder))
        log = self.log(table.name)
        entry = Commit(
            next_number(log.entries(spark)), run, batch, folder, found["rows"],
            found.get("low"), found.get("high"), key_bits, replaces,
        )
        log.append(spark, entry)
        return entry

    def _filter_path(self, table: Table, folder: str) -> str:
        return f"{self.root}/_keys/{table.name}/{FOLDER}={folder}"

    def _layout(self, table: Table) -> T.StructType:
        dated = [T.StructField(DATE, T.DateType())] if table.partition_date else []
        return T.StructType([*table.schema.fields, T.StructField(FOLDER, T.StringType()), *dated])

    def rows_of(self, spark: SparkSession, table: Table, commits: Iterable[Commit]) -> DataFrame:
        """Rows of these commits, with the columns by which they are nested."""
        layout, base = self._layout(table), self._path(table.name)
        paths = [f"{base}/{FOLDER}={c.folder}" for c in commits if c.rows]
        if not paths:
            return spark.createDataFrame([], layout)
        return spark.read.schema(layout).option("basePath", base).parquet(*paths)

    def commits(
        self, spark: SparkSession, table: Table, first: datetime | None = None, last: datetime | None = None,
        other_than: tuple[str, int] | None = None,
    ) -> list[Commit]:
        """Commits in force that may hold rows of a period, without those of one batch.

        A merge that took that batch in is left aside; its other parts are given in its place.
        """
        found = live(e for e in self.log(table.name).entries(spark) if e.of != other_than)
        period = first or datetime.min, last or datetime.max
        return [c for c in found if c.rows and c.may_hold(*period)]

    def read(
        self,
        spark: SparkSession,
        table: Table,
        other_than_batch: int | None = None,
        since: datetime | None = None,
        run: str = DIRECT,
    ) -> DataFrame:
        """Stored rows of finished batches.

        ``other_than_batch`` leaves out what a replay of that batch of ``run`` will
        replace. ``since`` is a lower time bound; writes and date folders before it are not opened.
        """
        other_than = None if other_than_batch is None else (run, other_than_batch)
        rows = self.rows_of(spark, table, self.commits(spark, table, first=since, other_than=other_than))
        if since is not None:
            recent = F.col(table.partition_date) >= moment(since)
            rows = rows.where((F.col(DATE) >= F.lit(since.date())) & recent)
        return rows.select(*table.columns)

    def read_period(self, spark: SparkSession, table: Table, first: str, last: str) -> DataFrame:
        """Stored rows of whole dates; other writes and date folders are not opened."""
        begin = datetime.combine(date.fromisoformat(first), time.min)
        end = datetime.combine(date.fromisoformat(last), time.max)
        rows = self.rows_of(spark, table, self.commits(spark, table, begin, end))
        return rows.where(F.col(DATE).between(first, last)).select(*table.columns)

    def stored_keys(
        self, rows: DataFrame, table: Table, first: datetime, last: datetime, batch: int, run: str
    ) -> DataFrame | None:
        """Primary keys that other batches have stored and that may be among those of ``rows``, whose times lie between
        ``first`` and ``last``; None if there are none.

        Equal rows have equal times, so only writes that hold times of the period count. Of these the key filters
        are looked up, and the keys of writes are read only where a filter has some key of the batch.
        """
        spark = rows.sparkSession
        others = self.commits(spark, table, first, last, other_than=(run, batch))
        hits: set[str] = set()
        for bits in sorted({c.key_bits for c in others}):
            paths = [self._filter_path(table, c.folder) for c in others if c.key_bits == bits]
            reader = spark.read.schema(keyfilter.SCHEMA).option("basePath", f"{self.root}/_keys/{table.name}")
            hits |= keyfilter.folders_with(rows, table.primary_key, reader.parquet(*paths), bits)
        opened = [c for c in others if c.folder in hits]
        self.last_check = KeyCheck(len(others), len(opened))
        if not opened:
            return None
        dated = F.col(DATE).between(F.lit(first.date()), F.lit(last.date()))
        return self.rows_of(spark, table, opened).where(dated).select(*table.primary_key)

    def merge(self, spark: SparkSession, table: Table, small: int = 1_000_000, fan_in: int = 8) -> Commit | None:
        """Put neighbouring small writes into one, in files of the usual size; None if there are too few.

        Writes of less than ``small`` rows that follow one another are taken, ``fan_in`` of them at least. The new
        entry replaces theirs at once: a reader that has begun reads the old folders, which stay, and a later
        one the new. If one of the batches is run again, its parts hold again without it.
        """
        now = self.commits(spark, table)
        taken: list[Commit] = []
        for commit in now:
            if commit.rows >= small:
                if len(taken) >= fan_in:
                    break
                taken = []
            else:
                taken.append(commit)
        if len(taken) < fan_in:
            return None
        return self.put_in_place_of(self.rows_of(spark, table, taken).select(*table.columns), table, taken)

    def put_in_place_of(self, rows: DataFrame, table: Table, taken: list[Commit]) -> Commit:
        """Write ``rows`` as what the ``taken`` writes come to; from its entry on it is read and they are not."""
        replaces = tuple(c.number for c in taken)
        return self._write(rows, table, "merge", replaces[-1], replaces, sum(c.rows for c in taken))

    def write_nested(self, rows: DataFrame, table: Table, nested: tuple[str, ...], batch: int, run: str = DIRECT) -> int:
        """Store a batch in folders by the ``nested`` columns, which come after those of the table; the number of rows."""
        spark, folder = rows.sparkSession, f"w{uuid.uuid4().hex}"
        path = f"{self._path(table.name)}/{FOLDER}={folder}"
        placed = rows.select(*table.columns, *nested).hint("rebalance", *[F.col(c) for c in nested])
        placed.write.partitionBy(*nested).parquet(path)
        count = spark.read.schema(table.schema).parquet(path).count()
        self._commit(spark, table.name, batch, run, folder, count)
        return count

    def read_nested(self, spark: SparkSession, table: Table, nested: tuple[str, str]) -> DataFrame:
        """Rows of ``write_nested``, with the ``nested`` columns: a text and a number. Filters on these skip folders."""
        fields = [T.StructField(nested[0], T.StringType()), T.StructField(nested[1], T.IntegerType())]
        layout, base = T.StructType([*table.schema.fields, *fields]), self._path(table.name)
        paths = [f"{base}/{FOLDER}={c.folder}" for c in self.log(table.name).live(spark) if c.rows]
        if not paths:
            return spark.createDataFrame([], layout)
        return spark.read.schema(layout).option("basePath", base).parquet(*paths)

    def withdraw(self, spark: SparkSession, table: Table, batch: int, run: str = DIRECT) -> None:
        """A batch that is run again and has no rows this time."""
        self._commit(spark, table.name, batch, run, "", 0)

    def write_dead_letters(self, letters: DataFrame, table: str, batch: int, run: str = DIRECT) -> None:
        """Keep a batch's letters in place of those it left before; no letters withdraw these."""
        spark, name = letters.sparkSession, f"{LETTERS}/{table}"
        folder, seen = f"w{uuid.uuid4().hex}", Observation()
        counted = letters.select("value").observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.text(f"{self._path(name)}/{FOLDER}={folder}")
        self._commit(spark, name, batch, run, folder, seen.get["rows"])

    def withdraw_dead_letters(self, spark: SparkSession, table: str, batch: int, run: str = DIRECT) -> None:
        """A batch that is run again and rejects nothing this time."""
        self._commit(spark, f"{LETTERS}/{table}", batch, run, "", 0)

    def _commit(self, spark: SparkSession, name: str, batch: int, run: str, folder: str, rows: int) -> None:
        log = self.log(name)
        entries = log.entries(spark)
        if rows or any(e.of == (run, batch) for e in entries):
            log.append(spark, Commit(next_number(entries), run, batch, folder, rows))

    def read_dead_letters(self, spark: SparkSession, table: str) -> DataFrame:
        base = self._path(f"{LETTERS}/{table}")
        paths = [f"{base}/{FOLDER}={c.folder}" for c in self.log(f"{LETTERS}/{table}").live(spark) if c.rows]
        return spark.read.schema(VALUE).text(paths) if paths else spark.createDataFrame([], VALUE)


def settled(df: DataFrame, folder: str) -> DataFrame:
    """Write once, read back: the result is computed once, survives lost
    executors, and has a known size, by which Spark decides on broadcasting."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
