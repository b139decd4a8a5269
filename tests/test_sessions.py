from playstream.operators.sessions import listening_sessions, session_duration_by_user
from tests.helpers import at, event, events, rows


def test_silence_longer_than_the_gap_starts_a_session(spark):
    times = ["10:00:00", "10:29:59", "10:59:59", "11:30:00", "12:30:00.5"]
    df = events(
        spark, [event(n, time=f"2024-01-01 {t}") for n, t in enumerate(times)] + [event(9, user=None)]
    )
    got = rows(listening_sessions(df), "session_start", "session_end", "plays")
    assert got == [
        (at("2024-01-01 10:00:00"), at("2024-01-01 10:59:59"), 3),
        (at("2024-01-01 11:30:00"), at("2024-01-01 11:30:00"), 1),
        (at("2024-01-01 12:30:00.500000"), at("2024-01-01 12:30:00.500000"), 1),
    ]
    assert rows(session_duration_by_user(df)) == [(1, 3, 3599 / 3)]


def test_sessions_equal_event_by_event_splitting(star):
    got = rows(listening_sessions(star.stream_events, 240))
    want, gap = [], 240 * 60
    plays = sorted((r.user_id, r.timestamp) for r in star.stream_events.where("user_id IS NOT NULL").collect())
    for user, time in plays:
        if want and want[-1][0] == user and (time - want[-1][2]).total_seconds() <= gap:
            want[-1] = (user, want[-1][1], time, want[-1][3] + 1)
        else:
            want.append((user, time, time, 1))
    assert got == sorted(want, key=str)


def test_a_stream_closes_the_same_sessions(spark, tmp_path):
    """Over several batches: a session that grows, one joined by an event between two, silences of exactly the gap."""
    from playstream.model import STREAM_EVENTS
    from playstream.operators.sessions import session_stream

    day = "2024-01-01 "
    batches = [
        [event(1, time=day + "00:00:00"), event(2, time=day + "00:20:00"), event(3, user=2, time=day + "00:00:00")],
        [event(4, time=day + "00:50:00"), event(5, time=day + "01:20:00.000001"), event(6, user=2, time=day + "00:40:00")],
        [event(7, user=2, time=day + "00:25:00"), event(8, user=None, time=day + "01:00:00")],
        [event(9, user=3, time=day + "09:00:00")],
    ]
    for n, batch in enumerate(batches):
        events(spark, batch).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(STREAM_EVENTS.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    timed = source.withColumn("timestamp", source["timestamp"].cast("timestamp")).withWatermark("timestamp", "3 hours")
    query = session_stream(timed).writeStream.format("memory").queryName("closed").outputMode("append")
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    everything = events(spark, [e for b in batches for e in b])
    want = listening_sessions(everything).where("user_id < 3").select("session_start", "user_id", "session_end", "plays")
    assert rows(spark.table("closed")) == rows(want.selectExpr("CAST(session_start AS TIMESTAMP)", "user_id", "CAST(session_end AS TIMESTAMP)", "plays"))
