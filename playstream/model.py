"""Table contracts: wire schemas, stored types, keys and references."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

FLAGS = (
    "is_complete_play",
    "is_skipped",
    "is_liked",
    "is_shared",
    "is_added_to_playlist",
)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_INT, _LONG, _TEXT = T.IntegerType(), T.LongType(), T.StringType()
_BOOL, _REAL, _DATE = T.BooleanType(), T.DoubleType(), T.DateType()
_WALL, _BYTES = T.TimestampNTZType(), T.BinaryType()


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``column`` must be NULL or present in ``parent.key``."""

    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class Table:
    """A stored table.

    ``schema`` holds the stored types. Event times are kept without a zone, as
    they arrive. ``wire`` is the JSON form, where times and dates are text.
    """

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    required: tuple[str, ...] = ()
    partition_date: str | None = None

    @property
    def wire(self) -> T.StructType:
        textual = (T.DateType, T.TimestampNTZType)
        return T.StructType(
            [
                T.StructField(f.name, _TEXT if isinstance(f.dataType, textual) else f.dataType, True)
                for f in self.schema.fields
            ]
        )

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


USERS = Table(
    "users",
    _struct(
        ("user_id", _INT), ("username", _TEXT), ("age", _INT), ("gender", _TEXT),
        ("subscription_type", _TEXT), ("registration_date", _DATE), ("country", _TEXT),
    ),
    primary_key=("user_id",),
    required=("user_id", "username"),
)
ARTISTS = Table(
    "artists",
    _struct(
        ("artist_id", _INT), ("name", _TEXT), ("country", _TEXT), ("genre", _TEXT), ("is_band", _BOOL),
    ),
    primary_key=("artist_id",),
    required=("artist_id", "name"),
)
ALBUMS = Table(
    "albums",
    _struct(
        ("album_id", _INT), ("title", _TEXT), ("artist_id", _INT), ("release_date", _DATE),
        ("total_tracks", _INT), ("album_type", _TEXT),
    ),
    primary_key=("album_id",),
    references=(Reference("artist_id", "artists", "artist_id"),),
    required=("album_id", "title"),
)
SONGS = Table(
    "songs",
    _struct(
        ("song_id", _INT), ("title", _TEXT), ("duration_seconds", _INT), ("release_date", _DATE),
        ("genre", _TEXT), ("language", _TEXT), ("explicit", _BOOL),
    ),
    primary_key=("song_id",),
    required=("song_id", "title"),
)
DEVICES = Table(
    "devices",
    _struct(
        ("device_id", _INT), ("device_type", _TEXT), ("os", _TEXT), ("browser", _TEXT), ("app_version", _TEXT),
    ),
    primary_key=("device_id",),
    required=("device_id",),
)
LOCATIONS = Table(
    "locations",
    _struct(
        ("location_id", _INT), ("country", _TEXT), ("region", _TEXT), ("city", _TEXT), ("timezone", _TEXT),
    ),
    primary_key=("location_id",),
    required=("location_id",),
)

_TO_USER = Reference("user_id", "users", "user_id")
_TO_SONG = Reference("song_id", "songs", "song_id")
_TO_ARTIST = Reference("artist_id", "artists", "artist_id")
_TO_ALBUM = Reference("album_id", "albums", "album_id")
_TO_DEVICE = Reference("device_id", "devices", "device_id")
_TO_LOCATION = Reference("location_id", "locations", "location_id")

STREAM_EVENTS = Table(
    "stream_events",
    _struct(
        ("event_id", _TEXT), ("user_id", _INT), ("song_id", _INT), ("artist_id", _INT), ("album_id", _INT),
        ("device_id", _INT), ("location_id", _INT), ("timestamp", _WALL), ("stream_duration_seconds", _INT),
        *((flag, _BOOL) for flag in FLAGS),
    ),
    primary_key=("event_id",),
    references=(_TO_USER, _TO_SONG, _TO_ARTIST, _TO_ALBUM, _TO_DEVICE, _TO_LOCATION),
    required=("event_id", "timestamp"),
    partition_date="timestamp",
)

USER_ENGAGEMENT = Table(
    "user_engagement_metrics",
    _struct(
        ("time_window", _WALL), ("user_id", _INT), ("stream_count", _LONG), ("total_listen_time", _LONG),
        ("avg_listen_time", _REAL), ("skip_rate", _REAL), ("like_rate", _REAL), ("share_rate", _REAL),
        ("playlist_add_rate", _REAL),
    ),
    primary_key=("time_window", "user_id"),
    references=(_TO_USER,),
    partition_date="time_window",
)
CONTENT_PERFORMANCE = Table(
    "content_performance_metrics",
    _struct(
        ("time_window", _WALL), ("song_id", _INT), ("artist_id", _INT), ("stream_count", _LONG),
        ("completion_rate", _REAL), ("skip_rate", _REAL), ("like_rate", _REAL),
    ),
    primary_key=("time_window", "song_id", "artist_id"),
    references=(_TO_SONG, _TO_ARTIST),
    partition_date="time_window",
)
DEVICE_METRICS = Table(
    "device_metrics",
    _struct(
        ("time_window", _WALL), ("device_id", _INT), ("stream_count", _LONG), ("avg_listen_time", _REAL),
        ("completion_rate", _REAL),
    ),
    primary_key=("time_window", "device_id"),
    references=(_TO_DEVICE,),
    partition_date="time_window",
)
LOCATION_METRICS = Table(
    "location_metrics",
    _struct(
        ("time_window", _WALL), ("location_id", _INT), ("stream_count", _LONG), ("unique_users", _LONG),
        ("unique_songs", _LONG),
    ),
    primary_key=("time_window", "location_id"),
    references=(_TO_LOCATION,),
    partition_date="time_window",
)
HOURLY_METRICS = Table(
    "hourly_metrics",
    _struct(
        ("time_window", _WALL), ("stream_count", _LONG), ("unique_users", _LONG), ("unique_songs", _LONG),
        ("unique_artists", _LONG), ("total_listen_time", _LONG), ("avg_listen_time", _REAL),
        ("skip_rate", _REAL), ("like_rate", _REAL),
    ),
    primary_key=("time_window",),
    partition_date="time_window",
)

# What adds up over windows: sums in place of rates, sketches and bitmaps in place of distinct counts.
HOURLY_SUMS = Table(
    "hourly_sums",
    _struct(
        ("time_window", _WALL), ("stream_count", _LONG), ("total_listen_time", _LONG), ("timed_count", _LONG),
        ("skipped", _LONG), ("liked", _LONG),
    ),
    primary_key=("time_window",),
    partition_date="time_window",
)
LOCATION_SKETCHES = Table(
    "location_sketches",
    _struct(
        ("time_window", _WALL), ("location_id", _INT), ("stream_count", _LONG), ("users", _BYTES), ("songs", _BYTES),
    ),
    primary_key=("time_window", "location_id"),
    references=(_TO_LOCATION,),
    partition_date="time_window",
)
USER_BITMAPS = Table(
    "user_bitmaps",
    _struct(("time_window", _WALL), ("bucket", _LONG), ("users", _BYTES)),
    primary_key=("time_window", "bucket"),
    partition_date="time_window",
)
USER_SESSIONS = Table(
    "user_sessions",
    _struct(("session_start", _WALL), ("user_id", _INT), ("session_end", _WALL), ("plays", _LONG)),
    primary_key=("session_start", "user_id"),
    partition_date="session_start",
)

# The newest state of a user, kept from a changelog.
CURRENT_USERS = Table(
    "current_users",
    _struct(("user_id", _INT), ("device_id", _INT), ("location_id", _INT), ("timestamp", _WALL)),
    primary_key=("user_id",),
)

DIMENSIONS = (USERS, ARTISTS, ALBUMS, SONGS, DEVICES, LOCATIONS)
METRIC_TABLES = (USER_ENGAGEMENT, CONTENT_PERFORMANCE, DEVICE_METRICS, LOCATION_METRICS, HOURLY_METRICS)
ADDITIVE_TABLES = (HOURLY_SUMS, LOCATION_SKETCHES, USER_BITMAPS)
TABLES = {t.name: t for t in (*DIMENSIONS, STREAM_EVENTS, *METRIC_TABLES, *ADDITIVE_TABLES, USER_SESSIONS)}


def load_order(tables=DIMENSIONS) -> list[Table]:
    """Parents before children, otherwise in the given order."""
    waiting, placed = list(tables), []
    names = {t.name for t in waiting}
    while waiting:
        done = {t.name for t in placed}
        ready = next(
            (t for t in waiting if all(r.parent in done or r.parent not in names for r in t.references)), None
        )
        if ready is None:
            raise ValueError("references form a cycle: " + ", ".join(t.name for t in waiting))
        placed.append(ready)
        waiting.remove(ready)
    return placed
