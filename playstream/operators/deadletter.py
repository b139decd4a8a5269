"""Dead-letter records: one JSON value holding the row and why it was rejected."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstream.model import Table
from playstream.operators.integrity import REASONS
from playstream.operators.parsing import parse_table, to_wire

ERROR_INFO = "error_info"
# Fields of the envelope, in order.
ENVELOPE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)


def _envelope(table: str, batch_id: int, message: Column, at: datetime) -> Column:
    return F.to_json(
        F.struct(
            F.lit(table).alias("table"),
            F.lit(batch_id).alias("batch_id"),
            message.alias("error_message"),
            F.lit(at.isoformat(sep=" ")).alias("timestamp"),
        )
    )


def to_dead_letters(
    rejected: DataFrame, table: str, batch_id: int, at: datetime, message: str | None = None
) -> DataFrame:
    """One ``value`` per rejected row. The message is given, or the row's own reasons."""
    text = F.lit(message) if message is not None else F.concat_ws("; ", REASONS)
    enveloped = rejected.withColumn(ERROR_INFO, _envelope(table, batch_id, text, at)).drop(REASONS)
    return enveloped.select(to_wire(enveloped).alias("value"))


def read_dead_letters(letters: DataFrame, table: Table) -> DataFrame:
    """Rows of one table back out of dead letters, typed, with the envelope fields."""
    info = F.from_json(F.get_json_object(F.col("value").cast("string"), f"$.{ERROR_INFO}"), ENVELOPE)
    opened = letters.select("value", info.alias("_info")).where(F.col("_info.table") == table.name)
    return parse_table(opened, table, keep=("_info",)).select(
        *table.columns,
        F.col("_info.batch_id").alias("failed_batch_id"),
        F.col("_info.error_message").alias("error_message"),
    )
