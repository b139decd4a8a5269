"""Set-based checks before a write: readable, complete, references known."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstream.model import Reference, Table
from playstream.operators.parsing import CORRUPT

REASONS = "_reasons"
MALFORMED = "Malformed record"
MISSING = "Missing required value: "
VIOLATION = "Foreign key violation: "


def used_keys(rows: DataFrame, references: Sequence[Reference]) -> DataFrame:
    """(reference, key, rows) for every key in use, NULL keys left out.

    One scan turns the key columns into pairs. They are counted before the
    shuffle, so a hot key costs one row per task.
    """
    return (
        rows.unpivot([], [r.column for r in references], "reference", "key")
        .where("key IS NOT NULL")
        .groupBy("reference", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def known_keys(dimensions: Mapping[str, DataFrame], references: Sequence[Reference]) -> DataFrame:
    parts = [
        dimensions[r.parent].selectExpr(f"'{r.column}' AS reference", f"{r.key} AS key") for r in references
    ]
    return reduce(DataFrame.unionByName, parts)


def broken_keys(
    rows: DataFrame, dimensions: Mapping[str, DataFrame], references: Sequence[Reference]
) -> DataFrame:
    """Keys in use that their dimension lacks: (reference, key, rows).

    Only distinct keys are shuffled and joined; the rows stay where they are.
    """
    return used_keys(rows, references).join(known_keys(dimensions, references), ["reference", "key"], "left_anti")


def broken_sizes(broken: DataFrame) -> dict[str, int]:
    """Number of broken keys per reference: at most one entry per reference."""
    return {r["reference"]: r["count"] for r in broken.groupBy("reference").count().collect()}


def _mark(rows: DataFrame, broken: DataFrame, ref: Reference) -> DataFrame:
    keys = broken.where(F.col("reference") == ref.column).selectExpr(
        f"key AS {ref.column}", f"true AS _broken_{ref.column}"
    )
    return rows.join(keys, ref.column, "left")


def with_reasons(
    rows: DataFrame, table: Table, broken: DataFrame | None = None, sizes: Mapping[str, int] | None = None
) -> DataFrame:
    """Add ``_reasons``, the list of why a row cannot be stored (empty if it can).

    ``sizes`` are the counted broken keys; references without any need no join.
    For the others Spark chooses by the size of the held keys, and splits the
    partitions of a hot key while it runs.
    """
    columns = rows.columns
    marked = rows
    reasons: list[str] = []
    if CORRUPT in columns:
        reasons.append(f"CASE WHEN {CORRUPT} IS NOT NULL THEN '{MALFORMED}' END")
    for name in table.required:
        is_missing = f"{name} IS NULL" + (f" AND {CORRUPT} IS NULL" if CORRUPT in columns else "")
        reasons.append(f"CASE WHEN {is_missing} THEN '{MISSING}{name}' END")
    for ref in table.references if broken is not None else ():
        if sizes is not None and not sizes.get(ref.column, 0):
            continue
        marked = _mark(marked, broken, ref)
        reasons.append(f"CASE WHEN _broken_{ref.column} THEN concat('{VIOLATION}{ref.column}=', {ref.column}) END")
    found = f"array_compact(array({', '.join(reasons)}))" if reasons else "CAST(array() AS ARRAY<STRING>)"
    return marked.select(*columns, F.expr(found).alias(REASONS))


def awaited(
    rows: DataFrame, broken: DataFrame, references: Sequence[Reference], sizes: Mapping[str, int]
) -> DataFrame:
    """Rows with the first of their broken references, as ``_reference`` and ``_key``; rows without any go. ``sizes``
    are the counted broken keys, not all zero."""
    columns, marked = rows.columns, rows
    lacking = [r for r in references if sizes.get(r.column)]
    for ref in lacking:
        marked = _mark(marked, broken, ref)
    cases = [f"CASE WHEN _broken_{r.column} THEN struct('{r.column}' AS r, CAST({r.column} AS BIGINT) AS k) END" for r in lacking]
    first = marked.withColumn("_first", F.expr(f"coalesce({', '.join(cases)})")).where("_first IS NOT NULL")
    return first.select(*columns, F.col("_first.r").alias("_reference"), F.col("_first.k").alias("_key"))


def valid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) == 0).drop(REASONS, CORRUPT)


def invalid(checked: DataFrame) -> DataFrame:
    return checked.where(F.size(REASONS) > 0)


def split_by_references(
    rows: DataFrame,
    table: Table,
    dimensions: Mapping[str, DataFrame],
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows to store, rows to reject). Any number of bad keys is handled at once.

    ``hold`` keeps the broken keys, as by writing them to a table, so that they
    are found once and can be counted.
    """
    broken, sizes = broken_keys(rows, dimensions, table.references), None
    if hold is not None:
        broken = hold(broken)
        sizes = broken_sizes(broken)
    checked = with_reasons(rows, table, broken, sizes)
    return valid(checked), invalid(checked)
