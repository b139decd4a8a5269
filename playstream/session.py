"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Catalyst defaults are kept unless listed here. AQE sizes batch shuffles and
# splits skewed join partitions; file splits stay small enough for one task.
BATCH_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
}

# AQE merges shuffle partitions but adds none, so batch jobs start with many.
INITIAL_PARTITIONS = 4000

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(
    app: str = "playstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    else:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(INITIAL_PARTITIONS))
    for key, value in {**BATCH_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session for stateful queries; the caller's settings stay as they are.

    The number of state partitions is fixed by the first run of a checkpoint, so
    it is set here and not left to AQE. State lives in RocksDB, off the heap.
    """
    sibling = spark.newSession()
    wanted = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sibling.conf.set("spark.sql.shuffle.partitions", str(wanted))
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    sibling.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return sibling


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine,
    which is removed when the program ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="playstream-")
        atexit.register(shutil.rmtree, _LOCAL_FOLDERS[app], ignore_errors=True)
    return _LOCAL_FOLDERS[app]


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
