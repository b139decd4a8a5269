"""Reconciliation that opens only what differs.

Metric rows are right if the events of their window, counted again, give the same. In place of counting everything again,
both sides keep digests: each event adds the hash of its user and minute, each metric row adds that hash times its
count. Sums do not depend on the order, add up over batches and corrections, and of two equal sums of 62-bit hashes the
rows behind are equal but for one chance in 2^62. Days are compared first, then the minutes of unequal days, and only events
and metric rows of unequal minutes are read. A level of hours would spare nothing: a day has 1,440 minutes.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstream.functions.timeparts import window_start
from playstream.model import Table
from playstream.sinks.store import DATE, DIRECT, FileStore

DIGEST = T.DecimalType(38, 0)
_TERM = T.DecimalType(19, 0)


def _term(*columns: str) -> F.Column:
    """62 bits, so that sums of any number of rows stay exact."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 62) - 1)).cast(_TERM)


def _summed(terms: DataFrame) -> DataFrame:
    totals = [F.sum("plays").cast("long").alias("plays"), F.sum("term").cast(DIGEST).alias("digest")]
    return terms.groupBy("time_window").agg(*totals)


def of_events(events: DataFrame) -> DataFrame:
    """``(time_window, plays, digest)`` of each minute of events with a user and a time."""
    usable = events.where("user_id IS NOT NULL AND timestamp IS NOT NULL")
    minutes = usable.select(window_start("timestamp", "1 minute").alias("time_window"), "user_id")
    return _summed(minutes.select("time_window", F.lit(1).alias("plays"), _term("time_window", "user_id").alias("term")))


def of_metrics(metrics: DataFrame) -> DataFrame:
    """The same from rows of user engagement."""
    plays = F.coalesce("stream_count", F.lit(0).cast("long"))
    usable = metrics.where("user_id IS NOT NULL AND time_window IS NOT NULL")
    times = (_term("time_window", "user_id") * plays).cast(DIGEST)
    return _summed(usable.select("time_window", plays.alias("plays"), times.alias("term")))


class DigestTree:
    """Digests of one side, kept beside its table: a table of minutes in date folders and a small table of days.

    Call ``add`` with what each batch stored, under its number; a batch that is run again takes its own place.
    """

    def __init__(self, store: FileStore, name: str):
        sums = [T.StructField("plays", T.LongType()), T.StructField("digest", DIGEST)]
        at = T.StructField("time_window", T.TimestampNTZType())
        self.store = store
        self.minutes = Table(f"{name}_minute_digests", T.StructType([at, *sums]), ("time_window",), partition_date="time_window")
        self.days = Table(f"{name}_day_digests", T.StructType([T.StructField("day", T.DateType()), *sums]), ("day",))

    def add(self, digests: DataFrame, batch: int, run: str = DIRECT) -> None:
        """Keep what a batch adds. The days are added up from the stored minutes of the batch."""
        spark = digests.sparkSession
        self.store.write(digests, self.minutes, batch, run)
        wrote = [c for c in self.store.commits(spark, self.minutes) if c.of == (run, batch)]
        minutes = self.store.rows_of(spark, self.minutes, wrote)
        totals = [F.sum(c).cast(t).alias(c) for c, t in (("plays", "long"), ("digest", DIGEST))]
        self.store.write(minutes.groupBy(F.col(DATE).alias("day")).agg(*totals), self.days, batch, run)

    def _unequal(self, mine: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
        """Keys whose sums differ. Both sides are added up together, so that no join is needed."""
        other = theirs.select(key, (-F.col("plays")).alias("plays"), (-F.col("digest")).alias("digest"))
        both = mine.select(key, "plays", "digest").unionByName(other)
        left = both.groupBy(key).agg(F.sum("plays").alias("plays"), F.sum("digest").alias("digest"))
        return left.where("plays <> 0 OR digest <> 0").select(key)

    def unequal_days(self, spark: SparkSession, other: DigestTree) -> list[date]:
        """Days on which the two sides differ; at most one entry for each day that is kept."""
        mine, theirs = (tree.store.read(spark, tree.days) for tree in (self, other))
        return sorted(r.day for r in self._unequal(mine, theirs, "day").collect())

    def unequal_minutes(self, spark: SparkSession, other: DigestTree, days: list[date]) -> DataFrame:
        """``time_window`` of the minutes that differ on these days; no other day is opened."""
        mine, theirs = (rows_of_days(spark, tree.store, tree.minutes, days) for tree in (self, other))
        return self._unequal(mine, theirs, "time_window")


def rows_of_days(spark: SparkSession, store: FileStore, table: Table, days: list[date]) -> DataFrame:
    """Stored rows of some dates. Writes without one of them are not opened, nor are other date folders."""
    held = [c for c in store.commits(spark, table) if c.low and any(c.low.date() <= d <= c.high.date() for d in days)]
    rows = store.rows_of(spark, table, held)
    return rows.where(F.col(DATE).isin(days) if days else F.lit(False)).select(*table.columns)


def differences(
    spark: SparkSession, store: FileStore, events: Table, metrics: Table, raw: DigestTree, counted: DigestTree
) -> DataFrame:
    """``(time_window, user_id, metrics_stream_count, calculated_stream_count)`` wherever the stored metrics and the stored
    events disagree, a missing row counting as 0. ``raw`` and ``counted`` are the digests of the two tables."""
    days = raw.unequal_days(spark, counted)
    minutes = raw.unequal_minutes(spark, counted, days)
    at = window_start("timestamp", "1 minute").alias("time_window")
    plays = rows_of_days(spark, store, events, days).where("user_id IS NOT NULL").select(at, "user_id")
    zero = F.lit(0).cast("long")
    sides = [
        plays.select("time_window", "user_id", zero.alias("claimed"), F.lit(1).cast("long").alias("found")),
        rows_of_days(spark, store, metrics, days).where("user_id IS NOT NULL").select(
            "time_window", "user_id", F.coalesce("stream_count", zero).alias("claimed"), zero.alias("found")
        ),
    ]
    met = sides[0].unionByName(sides[1]).join(minutes, "time_window", "left_semi")
    totals = [F.sum("claimed").alias("metrics_stream_count"), F.sum("found").alias("calculated_stream_count")]
    added = met.groupBy("time_window", "user_id").agg(*totals)
    return added.where("metrics_stream_count <> calculated_stream_count")
