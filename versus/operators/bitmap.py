"""A broadcast membership filter of fixed size, made of bitmaps.

Keys are hashed to one bit each; bits are gathered by aggregation into pieces of 32,768, so the
filter is a small table (piece, bits) and the test stays inside Spark's expressions. It never
loses a key that the table has; keys it lacks pass with about the share of bits that are set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 32_768
#: 8 MB, whatever the table: this is what makes the broadcast safe.
BITS = 1 << 26


def _place(on: list[str], bits: int):
    return F.pmod(F.xxhash64(*on), F.lit(bits))


def build_filter(table: DataFrame, on: list[str], bits: int = BITS) -> DataFrame:
    """(piece, bitmap) of the keys of ``table``: at most ``bits`` / 32,768 rows of 4 KB."""
    place = _place(on, bits)
    return (
        table.select(F.floor(place / PIECE).alias("piece"), (place % PIECE).alias("bit"))
        .groupBy("piece")
        .agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    )


def may_hold(rows: DataFrame, pieces: DataFrame, on: list[str], bits: int = BITS) -> DataFrame:
    """The rows whose key the filter does not rule out; rows with a null in the key go."""
    known = rows.where(" and ".join(f"`{c}` is not null" for c in on))
    place = _place(on, bits)
    small = pieces.select(F.col("piece").alias("__piece"), F.col("bitmap").alias("__bitmap"))
    met = known.withColumn("__place", place).join(
        F.broadcast(small), F.floor(F.col("__place") / PIECE) == F.col("__piece")
    )
    byte = F.expr(f"cast(conv(hex(substring(__bitmap, cast((__place % {PIECE}) div 8 as int) + 1, 1)), 16, 10) as int)")
    bit = F.expr("cast(__place % 8 as int)")
    return met.where(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1).select(*rows.columns)
