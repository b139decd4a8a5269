"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstream.session import run_folder

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    Cuts the lineage: what follows never recomputes ``frame``, whichever executor is lost.
    """
    spark = frame.sparkSession
    path = run_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder_of_id(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; null without an id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def bytes_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def small_batches(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of ``column``, so that memory follows the longest text and
    not the number of rows in an Arrow batch."""
    for batch in batches:
        sizes = [len(x) if x else 0 for x in bytes_of(batch.column(column))]
        start = held = 0
        for at, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
