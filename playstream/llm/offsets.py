"""Running totals over a whole table in two passes: one total per partition, then what lies before each partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstream.llm.common import settled

#: Partitions that are summed up together; the last window holds one row for so many partitions.
BLOCK = 1024


def before_parts(stored: DataFrame, amount: str, block: int = BLOCK) -> DataFrame:
    """``(part, before, overall)``: the sum of ``amount`` over all lesser ``part`` numbers, and over all rows.

    Partitions are summed first, then blocks of partitions, so no window holds more than ``block`` partitions or one
    row per block. The result is written, so that Spark knows its size when it chooses how to join it.
    """
    totals = stored.groupBy("part").agg(F.sum(amount).alias("total")).withColumn("block", F.expr(f"part div {block}"))
    totals = settled(totals, "part-totals")
    ahead = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        totals.groupBy("block")
        .agg(F.sum("total").alias("total"))
        .select(
            "block",
            F.coalesce(F.sum("total").over(ahead), F.lit(0)).alias("before_block"),
            F.sum("total").over(Window.partitionBy(F.lit(0))).alias("overall"),
        )
    )
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = totals.withColumn("before_part", F.coalesce(F.sum("total").over(inside), F.lit(0)))
    found = within.join(blocks, "block").select(
        "part", (F.col("before_block") + F.col("before_part")).alias("before"), "overall"
    )
    return settled(found, "part-offsets")
