"""A fixed-size key filter in DataFrame functions.

``may_hold(df, key, keys)`` keeps the rows whose key may be among ``keys``:
the keys set bits of a bitmap of ``BITS`` bits (4 KB pieces, at most
``BITS / 8`` bytes in all whatever the input), which is broadcast.  Rows it
lets through by chance are sorted out by the exact join that follows, so it
only saves shuffling rows that cannot match; a table with so many keys that
the bitmap fills lets every row through and loses the saving, not the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 8 MB of bitmap: the bound of what is broadcast.
BITS = 1 << 26


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS)) + 1


def may_hold(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose 64-bit ``key`` may be in ``keys`` (one column of
    64-bit keys); the columns stay as they are."""
    slot = _slot(F.col(keys.columns[0]))
    bitmap = keys.groupBy(F.bitmap_bucket_number(slot).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("__bits"))
    place = F.bitmap_bit_position(F.col("__slot"))
    byte = F.expr("substring(__bits, cast(bitmap_bit_position(__slot) div 8 + 1 as int), 1)")
    bit = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.element_at(
        F.array(*(F.lit(1 << b) for b in range(8))), (place % 8 + 1).cast("int"))) != 0
    probed = df.withColumn("__slot", _slot(key)).withColumn("__bucket", F.bitmap_bucket_number("__slot"))
    return probed.join(F.broadcast(bitmap), "__bucket").where(bit).select(*df.columns)
