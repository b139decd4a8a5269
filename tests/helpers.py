"""Literal rows for tests."""

from datetime import datetime

from pyspark.sql import types as T

from playstream.model import DIMENSIONS, STREAM_EVENTS, TABLES


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def event(n, user=1, song=1, artist=1, album=1, device=1, location=1, time="2024-01-30 12:00:00", seconds=60, **flags):
    values = {
        "event_id": f"ev-{n}",
        "user_id": user,
        "song_id": song,
        "artist_id": artist,
        "album_id": album,
        "device_id": device,
        "location_id": location,
        "timestamp": at(time) if time else None,
        "stream_duration_seconds": seconds,
        "is_complete_play": False,
        "is_skipped": False,
        "is_liked": False,
        "is_shared": False,
        "is_added_to_playlist": False,
    }
    return {**values, **flags}


def events(spark, rows):
    names = STREAM_EVENTS.columns
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], STREAM_EVENTS.schema)


def table(spark, name, *rows):
    """Rows given as dicts; columns left out are NULL."""
    schema = TABLES[name].schema
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


def dimensions(spark, size=3):
    """Every dimension with keys 1..size."""
    found = {}
    for t in DIMENSIONS:
        key = t.primary_key[0]
        rows = []
        for n in range(1, size + 1):
            row = {key: n}
            for field in t.schema.fields:
                if field.name != key and isinstance(field.dataType, T.StringType):
                    row[field.name] = f"{field.name} {n}"
            rows.append(row)
        found[t.name] = table(spark, t.name, *rows)
    return found


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
