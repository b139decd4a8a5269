"""Relational and columnar table scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """Where a relational store is, and how to log in."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    extra: tuple[tuple[str, str], ...] = ()

    def properties(self) -> dict[str, str]:
        given = {"driver": self.driver, "user": self.user, "password": self.password, **dict(self.extra)}
        return {key: value for key, value in given.items() if value is not None}


@dataclass(frozen=True)
class Split:
    """Read a table in ``parts`` ranges of a numeric, date or time column."""

    column: str
    lower: str
    upper: str
    parts: int


def scan_options(table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    options = {"dbtable": table, "fetchsize": str(fetch_size), "preferTimestampNTZ": "true"}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": split.lower,
            "upperBound": split.upper,
            "numPartitions": str(split.parts),
        }
    return options


def relational_scan(
    spark: SparkSession, connection: Connection, table: str, split: Split | None = None
) -> DataFrame:
    """Filters and column choice are pushed to the store by Spark."""
    return (
        spark.read.format("jdbc")
        .option("url", connection.url)
        .options(**connection.properties())
        .options(**scan_options(table, split))
        .load()
    )


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to SQL text of the same session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
