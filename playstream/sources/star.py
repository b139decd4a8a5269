"""The star schema, derived from a folder of order-and-event Parquet tables.

Each table is a projection, or one join with a small parent, so filters and
column choice on the derived table still reach the Parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream import model

# Category names by index.
GENDERS = ("Male", "Female", "Non-binary", "Prefer not to say")
GENRES = ("Pop", "Rock", "Hip Hop", "R&B", "Country", "Electronic", "Jazz", "Classical")
ALBUM_TYPES = ("LP", "EP", "Single", "Compilation")
DEVICE_TYPES = ("Mobile", "Desktop", "Tablet", "Smart Speaker", "Smart TV", "Car System")
OPERATING_SYSTEMS = ("iOS", "Android", "Windows", "macOS", "Linux")
BROWSERS = ("Safari", "Chrome", "Edge", "Firefox", "N/A")

# Order lines of one task of their join. A task sorts them and, in the same stage, keeps up to four groups of a line
# while it counts; file and shuffle sizes in bytes say little of that.
LINES_PER_TASK = 1 << 19

# Supplied columns in use. Declaring them saves a schema-reading job per scan.
SUPPLIED = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "documents": "doc_id bigint, text string",
}


def _pick(names: tuple[str, ...], key: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"element_at(array({listed}), CAST({key} % {len(names)} + 1 AS INT))"


def _released(key: str) -> str:
    return f"date_add(DATE '2014-01-01', CAST({key} * 13 % 3650 AS INT))"


def _shaped(df: DataFrame, table: model.Table, **columns: str) -> DataFrame:
    """Compute the columns, in the order and of the types the table declares."""
    return df.selectExpr(
        *[f"CAST({columns[f.name]} AS {f.dataType.simpleString()}) AS `{f.name}`" for f in table.schema.fields]
    )


class StarSchema:
    """Lazy access to the derived tables; but for row counts, nothing is read until a query runs."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def supplied(self, name: str) -> DataFrame:
        if name not in self._scans:
            reader = self.spark.read.schema(SUPPLIED[name])
            self._scans[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._scans[name]

    def _nation_of(self, name: str, nation_key: str) -> DataFrame:
        return self.supplied(name).join(self.supplied("nation"), F.expr(f"{nation_key} = n_nationkey"))

    @cached_property
    def users(self) -> DataFrame:
        return _shaped(
            self._nation_of("customer", "c_nationkey"),
            model.USERS,
            user_id="c_custkey",
            username="c_name",
            age="CASE WHEN c_custkey % 97 != 0 THEN 14 + c_custkey * 7 % 60 END",
            gender=_pick(GENDERS, "c_custkey"),
            subscription_type="c_mktsegment",
            registration_date="date_add(DATE '2021-01-01', CAST(c_custkey % 1000 AS INT))",
            country="n_name",
        )

    @cached_property
    def artists(self) -> DataFrame:
        return _shaped(
            self._nation_of("supplier", "s_nationkey"),
            model.ARTISTS,
            artist_id="s_suppkey",
            name="s_name",
            country="n_name",
            genre=_pick(GENRES, "s_suppkey"),
            is_band="s_suppkey % 2 = 0",
        )

    @cached_property
    def albums(self) -> DataFrame:
        suppliers = self._size(self.supplied("supplier")).alias("suppliers")
        return _shaped(
            self.supplied("part").select("*", suppliers),
            model.ALBUMS,
            album_id="p_partkey",
            title="p_name",
            artist_id="p_partkey % suppliers",
            release_date=_released("p_partkey"),
            total_tracks="5 + p_partkey % 11",
            album_type=_pick(ALBUM_TYPES, "p_partkey"),
        )

    @cached_property
    def songs(self) -> DataFrame:
        return _shaped(
            self.supplied("part"),
            model.SONGS,
            song_id="p_partkey",
            title="p_name",
            duration_seconds="120 + p_size * 6",
            release_date=_released("p_partkey"),
            genre="p_type",
            language="p_brand",
            explicit="p_partkey % 3 = 0",
        )

    @cached_property
    def devices(self) -> DataFrame:
        return _shaped(
            self.supplied("supplier"),
            model.DEVICES,
            device_id="s_suppkey",
            device_type=_pick(DEVICE_TYPES, "s_suppkey"),
            os=_pick(OPERATING_SYSTEMS, "s_suppkey"),
            browser=_pick(BROWSERS, "s_suppkey"),
            app_version="concat(1 + s_suppkey % 5, '.', s_suppkey % 10, '.0')",
        )

    @cached_property
    def locations(self) -> DataFrame:
        return _shaped(
            self.supplied("nation").join(self.supplied("region"), F.expr("n_regionkey = r_regionkey")),
            model.LOCATIONS,
            location_id="n_nationkey",
            country="n_name",
            region="r_name",
            city="concat('City_', n_nationkey)",
            timezone="concat('Zone_', n_regionkey)",
        )

    @staticmethod
    def _size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    def _as_play_events(self, raw: DataFrame, parts: Column, suppliers: Column) -> DataFrame:
        sized = raw.select("*", parts.alias("parts"), suppliers.alias("suppliers"))
        return _shaped(
            sized,
            model.STREAM_EVENTS,
            event_id="concat('ev-', event_id)",
            user_id="CASE WHEN event_id % 101 != 0 THEN user_id END",
            song_id="event_id * 37 % (parts + 4)",
            artist_id="event_id * 17 % (suppliers + 1)",
            album_id="event_id * 19 % (parts + 2)",
            device_id="event_id * 29 % (suppliers + 1)",
            location_id="event_id * 3 % 26",
            timestamp="ts",
            stream_duration_seconds="floor(value)",
            is_complete_play="event_type IN ('view', 'purchase', 'click')",
            is_skipped="event_type = 'error'",
            is_liked="event_type = 'purchase' OR event_id % 7 = 0",
            is_shared="event_id % 10 = 3",
            is_added_to_playlist="event_type = 'signup'",
        )

    @cached_property
    def stream_events(self) -> DataFrame:
        return self._as_play_events(
            self.supplied("events"),
            self._size(self.supplied("part")),
            self._size(self.supplied("supplier")),
        )

    @cached_property
    def order_events(self) -> DataFrame:
        """A larger fact of the same columns: one play per order line.

        The lines are counted first, from the files' footers. As long as Spark's own parts, one a core at least, hold
        no more than ``LINES_PER_TASK`` each, it deals them out itself; beyond, both sides get as many parts as that
        takes, which are not merged again.
        """
        lines, orders = self.supplied("lineitem"), self.supplied("orders")
        tasks = -(-lines.count() // LINES_PER_TASK)
        if tasks > self.spark.sparkContext.defaultParallelism:
            lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
        return _shaped(
            lines.join(orders, F.expr("l_orderkey = o_orderkey")),
            model.STREAM_EVENTS,
            event_id="concat('li-', l_orderkey, '-', l_linenumber)",
            user_id="o_custkey",
            song_id="l_partkey",
            artist_id="l_suppkey",
            album_id="l_partkey",
            device_id="l_linenumber",
            location_id="l_orderkey % 25",
            timestamp="l_shipdate",
            stream_duration_seconds="floor(l_quantity)",
            is_complete_play="l_linestatus = 'F'",
            is_skipped="l_returnflag = 'R'",
            is_liked="l_returnflag = 'A'",
            is_shared="l_linenumber = 1",
            is_added_to_playlist="l_linenumber = 7",
        )

    def stream_events_unbounded(self) -> DataFrame:
        """The same events read as a stream of files.

        Two row counts are taken first: a stream keeps no scalar subqueries.
        """
        raw = (
            self.spark.readStream.schema(SUPPLIED["events"])
            .option("pathGlobFilter", "events.parquet")
            .parquet(self.folder)
        )
        sizes = [self.supplied("part"), self.supplied("supplier")]
        return self._as_play_events(raw, *[F.lit(df.count()) for df in sizes])

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def dimensions(self) -> dict[str, DataFrame]:
        return {t.name: self.table(t.name) for t in model.DIMENSIONS}
