from datetime import datetime

from pyspark.sql import functions as F

from playstream.model import ALBUMS, ARTISTS, DEVICES, DIMENSIONS, USERS
from playstream.operators import changelog, loading
from playstream.sinks.store import FileStore
from tests.helpers import rows

AT = datetime(2024, 1, 31)


def log(spark, *entries):
    """(key, json, offset) messages."""
    packed = [
        (None if k is None else str(k).encode(), None if v is None else v.encode(), o) for k, v, o in entries
    ]
    return spark.createDataFrame(packed, "key binary, value binary, offset long")


def user(n, name):
    return f'{{"user_id":{n},"username":"{name}","registration_date":"2023-01-01"}}'


def test_the_newest_row_per_key_wins(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "b", 9), (1, "c", 7), (2, None, 1)], "id int, v string, o long")
    assert rows(changelog.latest_per_key(df, "id", "o")) == [(1, "b", 9), (2, None, 1)]


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS o", "cast(id AS string) AS v")
    plan = changelog.latest_per_key(df, "k", "o")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_stored_keys_are_not_inserted_again(spark):
    incoming = spark.createDataFrame([(1, "new"), (2, "b")], "id int, v string")
    stored = spark.createDataFrame([(1, "old")], "id int, v string")
    assert rows(changelog.new_rows(incoming, stored, "id")) == [(2, "b")]


def test_load_keeps_the_newest_new_rows_and_rejects(spark, tmp_path):
    store = FileStore(str(tmp_path))
    first = log(spark, (1, user(1, "one"), 0), (1, user(1, "uno"), 4), (2, user(2, "two"), 2))
    assert loading.load_table(first, USERS, store, 0, AT).loaded == 2
    second = log(
        spark,
        (1, user(1, "changed"), 5),  # stored already
        (3, user(3, "three"), 6),
        (4, user(4, "four"), 7),
        (4, None, 8),  # deleted again
        (None, user(5, "five"), 9),
        (None, "{bad", 10),
        (None, '{"k":1}', 11),  # no key at all
    )
    assert loading.load_table(second, USERS, store, 1, AT).loaded == 2
    assert rows(store.read(spark, USERS), "user_id", "username") == [(1, "uno"), (2, "two"), (3, "three"), (5, "five")]
    reasons = store.read_dead_letters(spark, "users").select(
        F.get_json_object(F.get_json_object("value", "$.error_info"), "$.error_message").alias("why")
    )
    assert rows(reasons) == [
        ("Malformed record",),
        ("Missing required value: user_id; Missing required value: username",),
    ]


def test_a_repeated_load_changes_nothing(spark, tmp_path):
    store = FileStore(str(tmp_path))
    messages = log(spark, *((n, user(n, f"u{n}"), n) for n in range(150)))
    for _ in range(2):
        assert loading.load_table(messages, USERS, store, 0, AT).loaded == 150
    assert store.read(spark, USERS).count() == 150


def test_children_are_checked_against_loaded_parents(spark, tmp_path):
    store = FileStore(str(tmp_path))
    empty = spark.createDataFrame([], "key binary, value binary, offset long")
    logs = {t.name: empty for t in DIMENSIONS}
    logs["artists"] = log(spark, (1, '{"artist_id":1,"name":"A"}', 0))
    logs["albums"] = log(
        spark,
        (1, '{"album_id":1,"title":"x","artist_id":1}', 0),
        (2, '{"album_id":2,"title":"y","artist_id":9}', 1),
        (3, '{"album_id":3,"title":"z"}', 2),
    )
    done = {r.table: r.loaded for r in loading.load_dimensions(logs, store, 0, AT)}
    assert done["artists"] == 1 and done["albums"] == 2 and done["devices"] == 0
    assert rows(store.read(spark, ALBUMS), "album_id") == [(1,), (3,)]
    assert store.read_dead_letters(spark, "albums").count() == 1
    assert store.read(spark, DEVICES).count() == 0
    assert store.read(spark, ARTISTS).count() == 1


def test_preview(spark):
    assert loading.preview(spark.range(100), 5).count() == 5
