"""Independent SQL for each checkable query, for DuckDB over the supplied tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

# The star schema as DuckDB sees it.
TABLES = {
    "users": """
        SELECT CAST(c_custkey AS INT) AS user_id, c_name AS username,
               CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE 14 + c_custkey * 7 % 60 END AS INT) AS age,
               ['Male', 'Female', 'Non-binary', 'Prefer not to say'][CAST(c_custkey % 4 AS INT) + 1] AS gender,
               c_mktsegment AS subscription_type,
               CAST(DATE '2021-01-01' + CAST(c_custkey % 1000 AS INT) AS DATE) AS registration_date,
               n_name AS country
        FROM customer, nation WHERE c_nationkey = n_nationkey""",
    "artists": """
        SELECT CAST(s_suppkey AS INT) AS artist_id, s_name AS name, n_name AS country,
               ['Pop', 'Rock', 'Hip Hop', 'R&B', 'Country', 'Electronic', 'Jazz', 'Classical']
                   [CAST(s_suppkey % 8 AS INT) + 1] AS genre,
               s_suppkey % 2 = 0 AS is_band
        FROM supplier, nation WHERE s_nationkey = n_nationkey""",
    "albums": """
        SELECT CAST(p_partkey AS INT) AS album_id, p_name AS title,
               CAST(p_partkey % (SELECT count(*) FROM supplier) AS INT) AS artist_id,
               CAST(DATE '2014-01-01' + CAST(p_partkey * 13 % 3650 AS INT) AS DATE) AS release_date,
               CAST(5 + p_partkey % 11 AS INT) AS total_tracks,
               ['LP', 'EP', 'Single', 'Compilation'][CAST(p_partkey % 4 AS INT) + 1] AS album_type
        FROM part""",
    "songs": """
        SELECT CAST(p_partkey AS INT) AS song_id, p_name AS title,
               CAST(120 + p_size * 6 AS INT) AS duration_seconds,
               CAST(DATE '2014-01-01' + CAST(p_partkey * 13 % 3650 AS INT) AS DATE) AS release_date,
               p_type AS genre, p_brand AS language, p_partkey % 3 = 0 AS explicit
        FROM part""",
    "devices": """
        SELECT CAST(s_suppkey AS INT) AS device_id,
               ['Mobile', 'Desktop', 'Tablet', 'Smart Speaker', 'Smart TV', 'Car System']
                   [CAST(s_suppkey % 6 AS INT) + 1] AS device_type,
               ['iOS', 'Android', 'Windows', 'macOS', 'Linux'][CAST(s_suppkey % 5 AS INT) + 1] AS os,
               ['Safari', 'Chrome', 'Edge', 'Firefox', 'N/A'][CAST(s_suppkey % 5 AS INT) + 1] AS browser,
               (1 + s_suppkey % 5) || '.' || (s_suppkey % 10) || '.0' AS app_version
        FROM supplier""",
    "locations": """
        SELECT n_nationkey AS location_id, n_name AS country, r_name AS region,
               'City_' || n_nationkey AS city, 'Zone_' || n_regionkey AS timezone
        FROM nation, region WHERE n_regionkey = r_regionkey""",
    "stream_events": """
        SELECT 'ev-' || event_id AS event_id,
               CAST(CASE WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS INT) AS user_id,
               CAST(event_id * 37 % ((SELECT count(*) FROM part) + 4) AS INT) AS song_id,
               CAST(event_id * 17 % ((SELECT count(*) FROM supplier) + 1) AS INT) AS artist_id,
               CAST(event_id * 19 % ((SELECT count(*) FROM part) + 2) AS INT) AS album_id,
               CAST(event_id * 29 % ((SELECT count(*) FROM supplier) + 1) AS INT) AS device_id,
               CAST(event_id * 3 % 26 AS INT) AS location_id,
               ts AS "timestamp",
               CAST(floor(value) AS INT) AS stream_duration_seconds,
               event_type IN ('view', 'purchase', 'click') AS is_complete_play,
               event_type = 'error' AS is_skipped,
               event_type = 'purchase' OR event_id % 7 = 0 AS is_liked,
               event_id % 10 = 3 AS is_shared,
               event_type = 'signup' AS is_added_to_playlist
        FROM events""",
    # Windowed metrics.
    "user_engagement_metrics": """
        SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS time_window, user_id,
               count(*) AS stream_count,
               CAST(sum(stream_duration_seconds) AS BIGINT) AS total_listen_time,
               avg(stream_duration_seconds) AS avg_listen_time,
               avg(CAST(is_skipped AS INT)) AS skip_rate, avg(CAST(is_liked AS INT)) AS like_rate,
               avg(CAST(is_shared AS INT)) AS share_rate,
               avg(CAST(is_added_to_playlist AS INT)) AS playlist_add_rate
        FROM stream_events GROUP BY ALL""",
    "content_performance_metrics": """
        SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS time_window, song_id, artist_id,
               count(*) AS stream_count, avg(CAST(is_complete_play AS INT)) AS completion_rate,
               avg(CAST(is_skipped AS INT)) AS skip_rate, avg(CAST(is_liked AS INT)) AS like_rate
        FROM stream_events GROUP BY ALL""",
    "device_metrics": """
        SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS time_window, device_id,
               count(*) AS stream_count, avg(stream_duration_seconds) AS avg_listen_time,
               avg(CAST(is_complete_play AS INT)) AS completion_rate
        FROM stream_events GROUP BY ALL""",
    "location_metrics": """
        SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS time_window, location_id,
               count(*) AS stream_count, count(DISTINCT user_id) AS unique_users,
               count(DISTINCT song_id) AS unique_songs
        FROM stream_events GROUP BY ALL""",
    "hourly_metrics": """
        SELECT date_trunc('hour', "timestamp") AS time_window, count(*) AS stream_count,
               count(DISTINCT user_id) AS unique_users, count(DISTINCT song_id) AS unique_songs,
               count(DISTINCT artist_id) AS unique_artists,
               CAST(sum(stream_duration_seconds) AS BIGINT) AS total_listen_time,
               avg(stream_duration_seconds) AS avg_listen_time,
               avg(CAST(is_skipped AS INT)) AS skip_rate, avg(CAST(is_liked AS INT)) AS like_rate
        FROM stream_events GROUP BY ALL""",
}


def _query(body: str, **more: str) -> str:
    named = {**TABLES, **more}
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in named.items())
    return f"WITH {ctes}\n{body}"


def _since(period: str, column: str = "time_window") -> str:
    return f"{column} >= {AS_OF} - INTERVAL {period}"


def _pct(part: str, whole: str = "count(*)") -> str:
    return f"CAST(round(100.0 * {part} / {whole}, 2) AS DOUBLE)"


METRIC_NAMES = (
    "user_engagement_metrics",
    "content_performance_metrics",
    "device_metrics",
    "location_metrics",
    "hourly_metrics",
)

BUSINESS = {
    "table_counts": "\nUNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS record_count FROM {name}" for name in TABLES
    ),
    "orphan_counts": "\nUNION ALL ".join(
        f"SELECT 'Orphaned {key}' AS issue, count(*) AS count FROM stream_events AS e"
        f" WHERE e.{key} IS NOT NULL AND NOT EXISTS (FROM {dim} AS d WHERE d.{key} = e.{key})"
        for key, dim in (
            ("user_id", "users"), ("song_id", "songs"), ("artist_id", "artists"),
            ("album_id", "albums"), ("device_id", "devices"), ("location_id", "locations"),
        )
    ),
    "top_songs": """
        SELECT title, name AS artist_name, count(*) AS stream_count
        FROM stream_events JOIN songs USING (song_id) JOIN artists USING (artist_id)
        GROUP BY ALL ORDER BY stream_count DESC, title, artist_name LIMIT 10""",
    "top_users": """
        SELECT username, subscription_type, count(*) AS stream_count,
               CAST(sum(stream_duration_seconds) AS BIGINT) AS total_listen_time
        FROM stream_events JOIN users USING (user_id)
        GROUP BY ALL ORDER BY stream_count DESC, username, subscription_type LIMIT 10""",
    "activity_by_hour": """
        SELECT CAST(hour("timestamp") AS INT) AS hour_of_day, count(*) AS stream_count,
               count(DISTINCT user_id) AS unique_users
        FROM stream_events GROUP BY ALL ORDER BY hour_of_day""",
    "activity_by_device": """
        SELECT device_type, os, count(*) AS stream_count, avg(stream_duration_seconds) AS avg_listen_time
        FROM stream_events JOIN devices USING (device_id) GROUP BY ALL ORDER BY stream_count DESC""",
    "skip_rate_by_genre": f"""
        SELECT genre, count(*) AS total_streams, count(*) FILTER (is_skipped) AS skipped_streams,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate
        FROM stream_events JOIN songs USING (song_id) GROUP BY genre""",
    "like_rate_by_genre": f"""
        SELECT genre, count(*) AS total_streams, count(*) FILTER (is_liked) AS liked_streams,
               {_pct('count(*) FILTER (is_liked)')} AS like_rate
        FROM stream_events JOIN songs USING (song_id) GROUP BY genre""",
    "activity_by_country": """
        SELECT country, count(*) AS stream_count, count(DISTINCT user_id) AS unique_users
        FROM stream_events JOIN locations USING (location_id)
        GROUP BY country ORDER BY stream_count DESC, country LIMIT 20""",
    "activity_by_subscription": f"""
        SELECT subscription_type, count(*) AS stream_count, count(DISTINCT user_id) AS unique_users,
               avg(stream_duration_seconds) AS avg_listen_time,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate,
               {_pct('count(*) FILTER (is_complete_play)')} AS completion_rate
        FROM stream_events JOIN users USING (user_id) GROUP BY subscription_type""",
    "engagement_by_age_group": f"""
        SELECT CASE WHEN age < 18 THEN 'Under 18' WHEN age <= 24 THEN '18-24' WHEN age <= 34 THEN '25-34'
                    WHEN age <= 44 THEN '35-44' WHEN age <= 54 THEN '45-54' ELSE '55+' END AS age_group,
               count(DISTINCT user_id) AS unique_users, count(*) AS stream_count,
               CAST(round(1.0 * count(*) / count(DISTINCT user_id), 2) AS DOUBLE) AS streams_per_user,
               CAST(round(avg(stream_duration_seconds), 2) AS DOUBLE) AS avg_listen_time,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate,
               {_pct('count(*) FILTER (is_liked)')} AS like_rate,
               {_pct('count(*) FILTER (is_shared)')} AS share_rate
        FROM stream_events JOIN users USING (user_id) GROUP BY age_group""",
    "dimension_completeness": """
        SELECT (SELECT count(DISTINCT user_id) FROM stream_events) AS unique_users_in_events,
               (SELECT count(*) FROM users) AS users_in_dimension,
               (SELECT count(DISTINCT song_id) FROM stream_events) AS unique_songs_in_events,
               (SELECT count(*) FROM songs) AS songs_in_dimension,
               (SELECT count(DISTINCT artist_id) FROM stream_events) AS unique_artists_in_events,
               (SELECT count(*) FROM artists) AS artists_in_dimension,
               (SELECT count(DISTINCT device_id) FROM stream_events) AS unique_devices_in_events,
               (SELECT count(*) FROM devices) AS devices_in_dimension,
               (SELECT count(DISTINCT location_id) FROM stream_events) AS unique_locations_in_events,
               (SELECT count(*) FROM locations) AS locations_in_dimension""",
    "metrics_reconciliation": """
        SELECT user_id, metrics_stream_count, calculated_stream_count, count_difference
        FROM (SELECT m.user_id, m.time_window, m.stream_count AS metrics_stream_count,
                     count(*) AS calculated_stream_count, abs(m.stream_count - count(*)) AS count_difference
              FROM user_engagement_metrics AS m JOIN stream_events AS e
                ON e.user_id = m.user_id AND e."timestamp" >= m.time_window
               AND e."timestamp" <= m.time_window + INTERVAL 5 MINUTE
              GROUP BY m.user_id, m.time_window, m.stream_count) AS compared
        WHERE count_difference > 0 ORDER BY user_id, time_window LIMIT 10""",
}

TRENDING = _query(
    """
    SELECT DISTINCT title, name AS artist_name, last_24h_streams, previous_24h_streams,
           CAST(CASE WHEN previous_24h_streams = 0 THEN 100
                     ELSE round(100.0 * (last_24h_streams - previous_24h_streams) / previous_24h_streams, 2)
                END AS DOUBLE) AS growth_percent
    FROM both_days JOIN songs USING (song_id)
         JOIN (SELECT DISTINCT song_id, artist_id FROM stream_events) AS pairs USING (song_id)
         JOIN artists USING (artist_id)
    ORDER BY growth_percent DESC, title, artist_name, last_24h_streams, previous_24h_streams LIMIT 20""",
    today=f"""SELECT song_id, count(*) AS n FROM stream_events
              WHERE {_since('24 HOUR', '"timestamp"')} GROUP BY song_id""",
    day_before=f"""SELECT song_id, count(*) AS n FROM stream_events
              WHERE {_since('48 HOUR', '"timestamp"')} AND NOT {_since('24 HOUR', '"timestamp"')} GROUP BY song_id""",
    both_days="""SELECT coalesce(t.song_id, d.song_id) AS song_id, coalesce(t.n, 0) AS last_24h_streams,
                        coalesce(d.n, 0) AS previous_24h_streams
                 FROM today AS t FULL JOIN day_before AS d ON t.song_id = d.song_id""",
)

HOUR, DAY = _since("1 HOUR"), _since("24 HOUR")


def _mean_by(metric: str, dim: str, key: str, attribute: str, column: str, name: str) -> str:
    return f"""SELECT {attribute}, avg({column}) AS {name} FROM {metric} JOIN {dim} USING ({key})
               WHERE {HOUR} GROUP BY {attribute}"""


def _streams_by(metric: str, dim: str, key: str, attribute: str) -> str:
    return f"""SELECT {attribute}, CAST(sum(stream_count) AS BIGINT) AS total_streams
               FROM {metric} JOIN {dim} USING ({key}) WHERE {HOUR} GROUP BY {attribute}"""


DASHBOARD = {
    "dash_active_users": f"""
        SELECT time_window, count(DISTINCT user_id) AS active_users
        FROM user_engagement_metrics WHERE {HOUR} GROUP BY time_window""",
    "dash_listen_time_by_subscription": _mean_by(
        "user_engagement_metrics", "users", "user_id", "subscription_type", "avg_listen_time", "average_listen_time"
    ),
    "dash_skip_rate_over_time": f"""
        SELECT time_window, avg(skip_rate) AS average_skip_rate
        FROM user_engagement_metrics WHERE {HOUR} GROUP BY time_window""",
    "dash_user_hour_heatmap": f"""
        SELECT CAST(hour(time_window) AS INT) AS hour_of_day, user_id,
               CAST(sum(stream_count) AS BIGINT) AS total_streams
        FROM user_engagement_metrics WHERE {DAY} GROUP BY ALL""",
    "dash_top_songs": f"""
        SELECT title AS song_title, CAST(sum(stream_count) AS BIGINT) AS total_streams
        FROM content_performance_metrics JOIN songs USING (song_id) WHERE {HOUR}
        GROUP BY title ORDER BY total_streams DESC, song_title LIMIT 10""",
    "dash_skip_rate_by_genre": _mean_by(
        "content_performance_metrics", "songs", "song_id", "genre", "skip_rate", "average_skip_rate"
    ),
    "dash_like_rate_over_time": f"""
        SELECT time_window, avg(like_rate) AS average_like_rate
        FROM content_performance_metrics WHERE {HOUR} GROUP BY time_window""",
    "dash_artist_comparison": f"""
        SELECT name AS artist_name, CAST(sum(stream_count) AS BIGINT) AS total_streams,
               avg(completion_rate) AS avg_completion_rate, avg(like_rate) AS avg_like_rate
        FROM content_performance_metrics JOIN artists USING (artist_id) WHERE {HOUR}
        GROUP BY name ORDER BY total_streams DESC, artist_name LIMIT 10""",
    "dash_streams_by_device_type": _streams_by("device_metrics", "devices", "device_id", "device_type"),
    "dash_listen_time_by_device_type": _mean_by(
        "device_metrics", "devices", "device_id", "device_type", "avg_listen_time", "average_listen_time"
    ),
    "dash_completion_by_os": _mean_by(
        "device_metrics", "devices", "device_id", "os", "completion_rate", "average_completion_rate"
    ),
    "dash_device_usage_over_time": f"""
        SELECT time_window, device_type, CAST(sum(stream_count) AS BIGINT) AS total_streams
        FROM device_metrics JOIN devices USING (device_id) WHERE {HOUR} GROUP BY ALL""",
    "dash_streams_by_country": _streams_by("location_metrics", "locations", "location_id", "country"),
    "dash_unique_users_by_region": f"""
        SELECT region, CAST(sum(unique_users) AS BIGINT) AS total_unique_users
        FROM location_metrics JOIN locations USING (location_id) WHERE {HOUR}
        GROUP BY region ORDER BY total_unique_users DESC, region LIMIT 10""",
    "dash_top_city_streams": f"""
        SELECT time_window, city, CAST(sum(stream_count) AS BIGINT) AS total_streams
        FROM location_metrics JOIN locations USING (location_id)
        WHERE {HOUR} AND city IN (
            SELECT city FROM location_metrics JOIN locations USING (location_id) WHERE {HOUR}
            GROUP BY city ORDER BY sum(stream_count) DESC, city LIMIT 5)
        GROUP BY ALL""",
    "dash_hourly_streams": f"SELECT time_window, stream_count FROM hourly_metrics WHERE {DAY}",
    "dash_hourly_uniques": f"SELECT time_window, unique_users, unique_songs FROM hourly_metrics WHERE {DAY}",
    "dash_hourly_rates": f"SELECT time_window, skip_rate, like_rate FROM hourly_metrics WHERE {DAY}",
    "dash_listen_time_by_hour": f"""
        SELECT CAST(hour(time_window) AS INT) AS hour_of_day, avg(avg_listen_time) AS average_listen_time
        FROM hourly_metrics WHERE {DAY} GROUP BY ALL""",
}


DASHBOARD["recent_engagement"] = f"""
    SELECT time_window, CAST(sum(stream_count) AS BIGINT) AS stream_count,
           avg(skip_rate) AS skip_rate, avg(like_rate) AS like_rate
    FROM user_engagement_metrics
    WHERE time_window BETWEEN {AS_OF} - INTERVAL 5 MINUTE AND {AS_OF} GROUP BY time_window"""

REFERENCES = (
    ("user_id", "users"), ("song_id", "songs"), ("artist_id", "artists"),
    ("album_id", "albums"), ("device_id", "devices"), ("location_id", "locations"),
)


def _is_broken(key: str, dim: str) -> str:
    return f"({key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {dim}))"


ANY_BROKEN = " OR ".join(_is_broken(key, dim) for key, dim in REFERENCES)
REASONS = (
    "concat_ws('; ', "
    + ", ".join(f"CASE WHEN {_is_broken(k, d)} THEN 'Foreign key violation: {k}=' || {k} END" for k, d in REFERENCES)
    + ")"
)
INVALID = f"SELECT *, {REASONS} AS reasons FROM stream_events WHERE {ANY_BROKEN}"

# A dead letter as text: fields in table order, NULL left out.
_INTS = ("user_id", "song_id", "artist_id", "album_id", "device_id", "location_id")
_BOOLS = ("is_complete_play", "is_skipped", "is_liked", "is_shared", "is_added_to_playlist")
_PIECES = [
    "'\"event_id\":\"' || event_id || '\"'",
    *(f"'\"{c}\":' || {c}" for c in _INTS),
    "'\"timestamp\":\"' || strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f') || '\"'",
    "'\"stream_duration_seconds\":' || stream_duration_seconds",
    *(f"'\"{c}\":' || {c}" for c in _BOOLS),
    """'"error_info":"' || replace('{"table":"stream_events","batch_id":0,"error_message":"' || reasons
        || '","timestamp":"2024-01-31 00:00:00"}', '"', '\\"') || '"'""",
]
LETTERS = f"SELECT '{{' || concat_ws(',', {', '.join(_PIECES)}) || '}}' AS value FROM invalid_rows"

CLOSED_BY = "(SELECT date_trunc('millisecond', max(\"timestamp\")) - INTERVAL 2 MINUTE FROM stream_events)"


def _closed(metric: str, width: str, *references: tuple[str, str]) -> str:
    """Windows that end by the final watermark and point at known dimension rows."""
    known = "".join(f" AND NOT {_is_broken(key, dim)}" for key, dim in references)
    return f"SELECT * FROM {metric} WHERE time_window + INTERVAL {width} <= {CLOSED_BY}{known}"


def _sketched(closed: str, *columns: str) -> str:
    """Streamed sketches have to lie within their error of these exact counts."""
    flags = ", ".join(f"true AS {c}_within_error" for c in columns)
    return f"SELECT * EXCLUDE ({', '.join(columns)}), {flags} FROM ({closed}) AS closed"


# Rows of the first days that come with a later batch are too late for their windows.
IN_TIME = f"""
    SELECT * FROM ({TABLES["stream_events"]}) AS arrived
    WHERE NOT (event_id LIKE '%7' AND "timestamp" < TIMESTAMP '2024-01-06 00:00:00')"""

DIMENSION_COLUMNS = {
    "users": "user_id username age gender subscription_type registration_date country",
    "artists": "artist_id name country genre is_band",
    "albums": "album_id title artist_id release_date total_tracks album_type",
    "songs": "song_id title duration_seconds release_date genre language explicit",
    "devices": "device_id device_type os browser app_version",
    "locations": "location_id country region city timezone",
}


def _fields(**changed: str) -> str:
    """Every column of every dimension as text, a row each."""
    parts = []
    for table, listed in DIMENSION_COLUMNS.items():
        columns = listed.split()
        parts += [
            f"SELECT '{table}' AS table_name, CAST({columns[0]} AS VARCHAR) AS id, '{c}' AS field, "
            f"CAST({changed.get(c, c)} AS VARCHAR) AS value FROM {table} WHERE {c} IS NOT NULL"
            for c in columns
        ]
    return " UNION ALL ".join(parts)


PIPELINE = {
    "parse_events": "SELECT * FROM stream_events",
    "parse_dimensions": _fields(),
    "loaded_dimensions": _fields(username="CASE WHEN user_id % 3 = 0 THEN 'new ' ELSE '' END || username"),
    "corrupt_records": "SELECT 'doc-' || doc_id AS message_key, text AS corrupt_record FROM documents",
    "flatten_window": """
        SELECT time_bucket(INTERVAL 1 MINUTE, "timestamp") AS time_window, count(*) AS stream_count
        FROM stream_events GROUP BY ALL""",
    "latest_per_key": """
        SELECT user_id, device_id, location_id, "timestamp", is_skipped, "offset"
        FROM (SELECT *, CAST(substr(event_id, 4) AS BIGINT) AS "offset",
                     row_number() OVER (PARTITION BY user_id ORDER BY CAST(substr(event_id, 4) AS BIGINT) DESC) AS nth
              FROM stream_events WHERE user_id IS NOT NULL) AS ranked
        WHERE nth = 1""",
    "new_dimension_rows": " UNION ALL ".join(
        f"SELECT '{dim}' AS table_name, {key} AS id FROM {dim} WHERE {key} NOT IN "
        f"(SELECT {key} FROM stream_events WHERE {key} IS NOT NULL)"
        for key, dim in REFERENCES
    ),
    "fk_valid_rows": f"FROM stream_events WHERE NOT ({ANY_BROKEN})",
    "fk_invalid_rows": INVALID,
    "stream_user_engagement": _closed("user_engagement_metrics", "1 MINUTE", ("user_id", "users")),
    "stream_content_performance": _closed(
        "content_performance_metrics", "1 MINUTE", ("song_id", "songs"), ("artist_id", "artists")
    ),
    "stream_device": _closed("device_metrics", "1 MINUTE", ("device_id", "devices")),
    "stream_hourly_measures": "SELECT * EXCLUDE (unique_users, unique_songs, unique_artists) FROM ("
    + _closed("hourly_metrics", "1 HOUR")
    + ") AS closed",
    "stream_hourly": _sketched(
        _closed("hourly_metrics", "1 HOUR"), "unique_users", "unique_songs", "unique_artists"
    ),
    "stream_location": _sketched(
        _closed("location_metrics", "1 MINUTE", ("location_id", "locations")), "unique_users", "unique_songs"
    ),
    "stream_raw_events": f"FROM stream_events WHERE NOT ({ANY_BROKEN})",
    "stream_repeated_events": f"FROM stream_events WHERE NOT ({ANY_BROKEN})",
    "replayed_dead_letters": f"""
        FROM stream_events WHERE ({ANY_BROKEN})
        AND NOT ({' OR '.join(_is_broken(k, d) for k, d in REFERENCES if d not in ('devices', 'locations'))})""",
}

# Streams that take events with a user only: Spark filters before it looks at the times.
CLOSED_BY_USERS = CLOSED_BY.replace("FROM stream_events", "FROM stream_events WHERE user_id IS NOT NULL")


def _events_closed(by: str) -> str:
    return f"""
        SELECT * FROM stream_events
        WHERE time_bucket(INTERVAL 1 MINUTE, "timestamp") + INTERVAL 1 MINUTE <= {by}"""


def _daily_users(events: str) -> str:
    return f"""
        SELECT CAST("timestamp" AS DATE) AS day, count(DISTINCT user_id) AS unique_users
        FROM ({events}) AS e WHERE user_id IS NOT NULL GROUP BY ALL"""


def _region_days(events: str) -> str:
    """Sketches have to lie within their error."""
    return f"""
        SELECT CAST("timestamp" AS DATE) AS day, region, count(*) AS stream_count,
               true AS unique_users_within_error, true AS unique_songs_within_error
        FROM ({events}) AS e JOIN locations USING (location_id) GROUP BY ALL"""


ADDITIVE = {
    "daily_unique_users": _daily_users("FROM stream_events"),
    "stream_daily_unique_users": _daily_users(_events_closed(CLOSED_BY_USERS)),
    "region_day_uniques": _region_days("FROM stream_events"),
    "stream_region_day_uniques": _region_days(_events_closed(CLOSED_BY)),
    "stream_corrected_hours": "SELECT * EXCLUDE (unique_users, unique_songs, unique_artists) FROM hourly_metrics",
    "stream_retried_events": f"FROM stream_events WHERE NOT ({ANY_BROKEN})",
    "plays_around_skips": """
        SELECT skip.event_id AS skip_id, skip.user_id, count(*) AS plays
        FROM stream_events AS skip JOIN stream_events AS play ON play.user_id = skip.user_id
         AND play."timestamp" >= skip."timestamp" - INTERVAL 17 MINUTE
         AND play."timestamp" < skip."timestamp" + INTERVAL 43 MINUTE
        WHERE skip.is_skipped GROUP BY ALL""",
}
_WRONG = "user_id % 50 = 7 AND CAST(time_window AS DATE) IN (DATE '2024-01-05', DATE '2024-01-17')"
_LOST = "user_id % 50 = 8 AND CAST(time_window AS DATE) = DATE '2024-01-05'"
KEPT_CURRENT = {
    "stream_current_users": """
        SELECT user_id, device_id, location_id, "timestamp" FROM stream_events WHERE user_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(substr(event_id, 4) AS BIGINT) DESC) = 1
            AND NOT is_skipped""",
    "released_rows": PIPELINE["replayed_dead_letters"],
    "digest_differences": f"""
        SELECT time_window, user_id,
               CASE WHEN {_LOST} THEN 0 ELSE stream_count + 1 END AS metrics_stream_count,
               stream_count AS calculated_stream_count
        FROM user_engagement_metrics WHERE user_id IS NOT NULL AND (({_WRONG}) OR ({_LOST}))""",
    "top_artists_from_windows": """
        SELECT artist_id, count(*) AS stream_count FROM stream_events WHERE artist_id IS NOT NULL
        GROUP BY artist_id ORDER BY stream_count DESC, artist_id LIMIT 10""",
    "song_counts_within_bounds": """
        SELECT time_bucket(INTERVAL 1 DAY, "timestamp") AS time_window, song_id, count(*) AS stream_count,
               true AS within_bounds
        FROM stream_events GROUP BY ALL""",
}
# The dimensions of the second run.
REPLAYED = {
    "users": f"""
        SELECT * FROM ({TABLES["users"]}) AS u WHERE user_id NOT IN (
            SELECT user_id FROM ({TABLES["stream_events"]}) AS e
            WHERE user_id IS NOT NULL AND "timestamp" < TIMESTAMP '2024-01-03 00:00:00')""",
    "devices": f"""
        SELECT device_id FROM ({TABLES["devices"]}) AS d
        UNION SELECT device_id FROM ({TABLES["stream_events"]}) AS e""",
}

FURTHER = {
    "session_duration_by_user": """
        SELECT user_id, count(*) AS sessions,
               CAST(sum(epoch_us(ended) - epoch_us(began)) AS BIGINT) / count(*) / 1000000 AS avg_session_seconds
        FROM (SELECT user_id, nth, min("timestamp") AS began, max("timestamp") AS ended
              FROM (SELECT *, count(*) FILTER (fresh) OVER (
                               PARTITION BY user_id ORDER BY "timestamp", event_id
                               ROWS UNBOUNDED PRECEDING) AS nth
                    FROM (SELECT *, coalesce("timestamp" - lag("timestamp") OVER (
                                     PARTITION BY user_id ORDER BY "timestamp", event_id) > INTERVAL 30 MINUTE,
                                     true) AS fresh
                          FROM stream_events WHERE user_id IS NOT NULL) AS marked) AS numbered
              GROUP BY user_id, nth) AS runs
        GROUP BY user_id""",
    "top_artists": """
        SELECT name AS artist_name, count(*) AS stream_count FROM stream_events JOIN artists USING (artist_id)
        GROUP BY name ORDER BY stream_count DESC, artist_name LIMIT 10""",
    "top_genres": """
        SELECT genre, count(*) AS stream_count FROM stream_events JOIN songs USING (song_id)
        GROUP BY genre ORDER BY stream_count DESC, genre LIMIT 10""",
    "skip_rate_by_song": f"""
        SELECT title, count(*) AS total_streams, count(*) FILTER (is_skipped) AS skipped_streams,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate
        FROM stream_events JOIN songs USING (song_id) GROUP BY title""",
    "skip_rate_by_artist": f"""
        SELECT name, count(*) AS total_streams, count(*) FILTER (is_skipped) AS skipped_streams,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate
        FROM stream_events JOIN artists USING (artist_id) GROUP BY name""",
    "user_summary": f"""
        SELECT user_id, username, count(*) AS stream_count, count(DISTINCT song_id) AS songs_played,
               CAST(sum(stream_duration_seconds) AS BIGINT) AS total_listen_time,
               {_pct('count(*) FILTER (is_skipped)')} AS skip_rate,
               {_pct('count(*) FILTER (is_liked)')} AS like_rate
        FROM stream_events JOIN users USING (user_id) GROUP BY user_id, username""",
    "activity_by_weekday": """
        SELECT CAST(dayofweek("timestamp") + 1 AS INT) AS day_of_week, count(*) AS stream_count,
               count(DISTINCT user_id) AS unique_users
        FROM stream_events GROUP BY ALL""",
    "popular_genres_by_region": """
        SELECT region, genre, count(*) AS stream_count,
               CAST(row_number() OVER (PARTITION BY region ORDER BY count(*) DESC, genre) AS INT) AS genre_rank
        FROM stream_events JOIN songs USING (song_id) JOIN locations USING (location_id)
        GROUP BY region, genre QUALIFY genre_rank <= 3""",
    "engagement_by_subscription": f"""
        SELECT subscription_type, count(*) AS stream_count, count(DISTINCT user_id) AS unique_users,
               CAST(round(1.0 * count(*) / count(DISTINCT user_id), 2) AS DOUBLE) AS streams_per_user,
               {_pct('count(*) FILTER (is_liked)')} AS like_rate
        FROM stream_events JOIN users USING (user_id) GROUP BY subscription_type""",
    "completion_by_device_type": f"""
        SELECT device_type, count(*) AS total_streams, count(*) FILTER (is_complete_play) AS completed_streams,
               {_pct('count(*) FILTER (is_complete_play)')} AS completion_rate
        FROM stream_events JOIN devices USING (device_id) GROUP BY device_type""",
    "listen_time_by_device_type_and_os": """
        SELECT device_type, os, avg(stream_duration_seconds) AS avg_listen_time
        FROM stream_events JOIN devices USING (device_id) GROUP BY device_type, os""",
    "users_by_country": """
        SELECT country, count(DISTINCT user_id) AS unique_users
        FROM stream_events JOIN locations USING (location_id) GROUP BY country""",
    "activity_by_region": """
        SELECT region, count(*) AS stream_count, count(DISTINCT user_id) AS unique_users
        FROM stream_events JOIN locations USING (location_id) GROUP BY region""",
}

# The larger fact, under the name of the fact table.
ORDER_EVENTS = """
    SELECT 'li-' || l_orderkey || '-' || l_linenumber AS event_id, CAST(o_custkey AS INT) AS user_id,
           CAST(l_partkey AS INT) AS song_id, CAST(l_suppkey AS INT) AS artist_id,
           CAST(l_partkey AS INT) AS album_id, l_linenumber AS device_id,
           CAST(l_orderkey % 25 AS INT) AS location_id, l_shipdate AS "timestamp",
           CAST(floor(l_quantity) AS INT) AS stream_duration_seconds, l_linestatus = 'F' AS is_complete_play,
           l_returnflag = 'R' AS is_skipped, l_returnflag = 'A' AS is_liked, l_linenumber = 1 AS is_shared,
           l_linenumber = 7 AS is_added_to_playlist
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
VOLUME = {
    "volume_user_engagement": "SELECT * FROM user_engagement_metrics",
    "volume_hourly": "SELECT * FROM hourly_metrics",
    "volume_top_songs": BUSINESS["top_songs"],
    "volume_activity_by_subscription": BUSINESS["activity_by_subscription"],
    "volume_engagement_by_age_group": BUSINESS["engagement_by_age_group"],
    "volume_popular_genres_by_region": FURTHER["popular_genres_by_region"],
    "volume_orphan_counts": BUSINESS["orphan_counts"],
    "volume_user_summary": FURTHER["user_summary"],
}

# Charts and reports over stored metric tables, and the same over computed ones.
STORED = {
    "stored_table_counts": "table_counts",
    "stored_metrics_reconciliation": "metrics_reconciliation",
    "stored_active_users": "dash_active_users",
    "stored_streams_by_country": "dash_streams_by_country",
    "stored_hourly_rates": "dash_hourly_rates",
    "stored_recent_engagement": "recent_engagement",
}


def oracle_sql() -> dict[str, str]:
    found = {name: _query(f"SELECT * FROM {name}") for name in METRIC_NAMES}
    found |= {name: _query(body) for name, body in BUSINESS.items()}
    found["trending_songs"] = TRENDING
    found |= {name: _query(body) for name, body in DASHBOARD.items()}
    found |= {name: _query(body) for name, body in (FURTHER | PIPELINE).items()}
    found |= {name: _query(body, stream_events=ORDER_EVENTS) for name, body in VOLUME.items()}
    for stored, computed in STORED.items():
        found[stored] = found[computed]
    found["stream_late_rows"] = _query(PIPELINE["stream_hourly_measures"], stream_events=IN_TIME)
    found |= {name: _query(body) for name, body in (ADDITIVE | KEPT_CURRENT).items()}
    found["replayed_batch"] = _query(
        f"""SELECT event_id, "timestamp", CASE WHEN {ANY_BROKEN} THEN 'dead letter' ELSE 'stored' END AS place
        FROM stream_events""",
        **REPLAYED,
    )
    found["stream_sessions"] = _query(
        FURTHER["session_duration_by_user"].replace(
            "GROUP BY user_id, nth) AS runs",
            f"GROUP BY user_id, nth) AS runs WHERE ended + INTERVAL 30 MINUTE <= {CLOSED_BY_USERS}",
        )
    )
    for name in ("dead_letter_rows", "stream_dead_letters"):
        found[name] = _query(LETTERS, invalid_rows=INVALID)
    return found
