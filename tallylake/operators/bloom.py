"""A fixed-size filter of keys, in built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of one bitmap, as Spark builds them.
BITMAP_BITS = 32_768
#: Bits for each key: one row in 32 that is not among the keys passes.
BITS_PER_KEY = 32
#: More bytes than this are not broadcast; the rows are then given back as they are.
MAX_BYTES = 64 << 20


def _slot(column: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(slots))


def maybe_among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` may be among the ``keys``' column of that name.

    Every row that is among them stays, and few others.  The filter is built in Spark, one
    bitmap a row, and joined by broadcast; its size is bounded whatever the number of keys.
    A join that decides exactly has to follow.
    """
    slots, wanted = BITMAP_BITS, keys.count() * BITS_PER_KEY
    while slots < wanted:
        slots *= 2
    if slots // 8 > MAX_BYTES:
        return rows
    slot = _slot(F.col(column), slots)
    bitmaps = keys.select(slot.alias("_slot")).groupBy(
        F.floor(F.col("_slot") / BITMAP_BITS).alias("_map")
    )
    bitmaps = bitmaps.agg(F.bitmap_construct_agg(F.col("_slot") % BITMAP_BITS).alias("_bits"))
    bit = F.col("_slot") % BITMAP_BITS
    byte = F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.getbit(value, (bit % 8).cast("int")) == 1
    return (
        rows.withColumn("_slot", slot)
        .withColumn("_map", F.floor(F.col("_slot") / BITMAP_BITS))
        .join(F.broadcast(bitmaps), "_map")
        .where(is_set)
        .drop("_slot", "_map", "_bits")
    )
