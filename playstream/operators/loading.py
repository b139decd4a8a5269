"""Dimension loads: changelog in, new rows stored, rejects kept."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.model import DIMENSIONS, Table, load_order
from playstream.operators.changelog import latest_per_key, new_rows
from playstream.operators.deadletter import to_dead_letters
from playstream.operators.integrity import broken_keys, broken_sizes, invalid, valid, with_reasons
from playstream.operators.parsing import CORRUPT, parse_dimension
from playstream.sinks.store import FileStore


@dataclass(frozen=True)
class LoadResult:
    table: str
    loaded: int


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    return rows.limit(n)


def current_rows(messages: DataFrame, table: Table, order: str = "offset") -> DataFrame:
    """The newest message of each entity, typed.

    The entity is the message key or, without one, the primary key in the text.
    An entity whose newest message has no value was deleted and is left out.
    Messages of no known entity are kept, to be rejected by the checks.
    """
    parsed = parse_dimension(messages, table, keep=("key", "value", order))
    entity = F.coalesce(F.col("key").cast("string"), F.col(table.primary_key[0]).cast("string"))
    named = parsed.withColumn("entity", entity)
    newest = latest_per_key(named.where(F.col("entity").isNotNull()), "entity", order)
    nameless = named.where(F.col("entity").isNull())
    return newest.unionByName(nameless).where(F.col("value").isNotNull()).select(*table.columns, CORRUPT)


def load_table(
    messages: DataFrame,
    table: Table,
    store: FileStore,
    batch: int,
    at: datetime,
    order: str = "offset",
    run: str = "load",
) -> LoadResult:
    """Store the keys not stored yet; reject what fails the checks.

    The new rows are kept for the check and the two writes, so the changelog is
    read and compacted once.
    """
    spark = messages.sparkSession
    incoming = current_rows(messages, table, order)
    existing = store.read(spark, table, other_than_batch=batch, run=run)
    fresh = new_rows(incoming, existing, table.primary_key).persist(StorageLevel.MEMORY_AND_DISK)
    parents = {r.parent: store.read(spark, _dimension(r.parent)) for r in table.references}
    broken = broken_keys(fresh, parents, table.references) if parents else None
    if broken is not None:
        broken = broken.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = None if broken is None else broken_sizes(broken)
        checked = with_reasons(fresh, table, broken, sizes)
        rejected = invalid(checked)
        n_fresh, n_rejected = fresh.count(), rejected.count()
        loaded = n_fresh - n_rejected
        if loaded:
            store.write(valid(checked), table, batch, run, loaded)
        else:
            store.withdraw(spark, table, batch, run)
        if n_rejected:
            store.write_dead_letters(to_dead_letters(rejected, table.name, batch, at), table.name, batch, run)
        else:
            store.withdraw_dead_letters(spark, table.name, batch, run)
        return LoadResult(table.name, loaded)
    finally:
        fresh.unpersist()
        if broken is not None:
            broken.unpersist()


def _dimension(name: str) -> Table:
    return next(t for t in DIMENSIONS if t.name == name)


def load_dimensions(
    changelogs: Mapping[str, DataFrame] | Callable[[str], DataFrame],
    store: FileStore,
    batch: int,
    at: datetime,
    order: str = "offset",
) -> list[LoadResult]:
    """Every dimension, parents first; tables that wait for no other are loaded at the same time. A failure stops the
    load; run it again with the same batch number."""
    read = changelogs if callable(changelogs) else changelogs.__getitem__
    waiting, results = load_order(), {}
    with ThreadPoolExecutor(max_workers=len(waiting)) as workers:
        while waiting:
            names = {t.name for t in waiting}
            ready = [t for t in waiting if not any(r.parent in names for r in t.references)]
            messages = [read(t.name) for t in ready]
            loads = workers.map(lambda m, t: load_table(m, t, store, batch, at, order), messages, ready)
            results |= {r.table: r for r in loads}
            waiting = [t for t in waiting if t not in ready]
    return [results[t.name] for t in load_order()]
