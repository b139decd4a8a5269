"""Arguments that the programs share."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from playstream import model
from playstream.sinks.store import FileStore


def parser(what: str) -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(description=what)
    made.add_argument("--root", required=True, help="folder of the stored tables")
    return made


def arguments(made: argparse.ArgumentParser, given: Sequence[str] | None) -> argparse.Namespace:
    return made.parse_args(given)


def dimensions(store: FileStore, spark: SparkSession) -> dict[str, DataFrame]:
    return {t.name: store.read(spark, t) for t in model.DIMENSIONS}
