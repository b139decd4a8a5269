"""Bloom filters over the keys of a write, as bitmaps in a small table of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits that a key sets, and bits of the filter per key: about one key in 400 is reported by mistake.
HASHES, BITS_PER_KEY = 4, 16
#: Bits of one bitmap, which is what ``bitmap_construct_agg`` makes.
BITMAP = 32_768
BITS_PER_FILE = 1 << 30
SCHEMA = T.StructType(
    [
        T.StructField("part", T.LongType()),
        T.StructField("bitmap", T.BinaryType()),
        T.StructField("folder", T.StringType()),
    ]
)


def bits_for(rows: int) -> int:
    """Bits of a filter: a power of two, so that writes of about one size share the places of a key."""
    return max(BITMAP, 1 << (BITS_PER_KEY * rows - 1).bit_length())


def _places(keys: Sequence[str], bits: int) -> Column:
    spots = [F.xxhash64(*keys, F.lit(n)).bitwiseAND(F.lit(bits - 1)) for n in range(HASHES)]
    return F.explode(F.array(*spots))


def built(rows: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``(part, bitmap)``: a filter of ``bits`` bits over the keys of ``rows``, combined before the shuffle."""
    spots = rows.select(_places(keys, bits).alias("at"))
    return spots.groupBy(F.expr(f"at div {BITMAP}").alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % BITMAP).alias("bitmap")
    )


def folders_with(rows: DataFrame, keys: Sequence[str], filters: DataFrame, bits: int) -> set[str]:
    """Folders whose filter (``filters``: part, bitmap, folder) has all bits of some key of ``rows``."""
    spots = rows.select(F.xxhash64(*keys).alias("key"), _places(keys, bits).alias("at"))
    spots = spots.withColumn("part", F.expr(f"at div {BITMAP}"))
    octet = F.expr(f"conv(hex(substring(bitmap, cast(at % {BITMAP} div 8 + 1 as int), 1)), 16, 10)").cast("int")
    is_set = F.expr("cast(at % 8 as int)")
    found = (
        spots.join(filters, "part")
        .select("folder", "key", "at", octet.alias("octet"), is_set.alias("bit"))
        .where("shiftright(octet, bit) & 1 = 1")
        .groupBy("folder", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= HASHES)
    )
    return {r.folder for r in found.select("folder").distinct().collect()}
