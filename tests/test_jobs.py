"""The programs, one after the other, over one folder of tables."""

from playstream.jobs import load, replay, stream, validate
from playstream.model import DIMENSIONS, LOCATIONS, METRIC_TABLES, STREAM_EVENTS
from playstream.operators.parsing import as_messages, to_wire
from playstream.sinks.store import FileStore


def dump(rows, table, folder, order=0):
    numbered = rows.selectExpr("*", f"CAST({order} AS LONG) AS offset")
    as_messages(numbered, table.primary_key[0], "offset").write.parquet(f"{folder}/{table.name}")


def test_load_stream_validate_and_replay(spark, star, tmp_path):
    root, inbox, dumps = (str(tmp_path / name) for name in ("tables", "inbox", "dumps"))
    for table in DIMENSIONS:
        rows = star.table(table.name)
        dump(rows.where("location_id < 20") if table is LOCATIONS else rows, table, dumps)
    given = ["--root", root, "--messages", dumps, "--batch", "0"]
    assert {r.table: r.loaded for r in load.main(given, spark)}["users"] == star.users.count()
    assert {r.table: r.loaded for r in load.main(given, spark)}["users"] == star.users.count()
    star.stream_events.limit(300).select(to_wire(star.stream_events).alias("value")).write.text(inbox)
    store = FileStore(root)
    stream.main(
        ["--root", root, "--messages", inbox, "--checkpoints", str(tmp_path / "cp"), "--state-partitions", "2", "--drain"],
        spark,
    )
    stored = store.read(spark, STREAM_EVENTS).count()
    letters = store.read_dead_letters(spark, STREAM_EVENTS.name).count()
    assert stored + letters == 300 and 0 < stored < 300
    assert store.read(spark, METRIC_TABLES[0]).count() > 0
    assert validate.main(["--root", root], spark) == 0
    dump(star.locations, LOCATIONS, str(tmp_path / "more"))
    for table in DIMENSIONS:
        if table is not LOCATIONS:
            dump(star.table(table.name).limit(0), table, str(tmp_path / "more"))
    loaded = load.main(["--root", root, "--messages", str(tmp_path / "more"), "--batch", "1"], spark)
    assert {r.table: r.loaded for r in loaded}["locations"] == 5
    again = replay.main(["--root", root, "--batch", "0"], spark)
    assert again > 0 and replay.main(["--root", root, "--batch", "0"], spark) == again
    assert replay.main(["--root", root, "--batch", "1"], spark) == 0
    assert store.read(spark, STREAM_EVENTS).count() == stored + again
    assert validate.main(["--root", root], spark) == 0
