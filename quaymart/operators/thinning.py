"""Rows that a join by keys cannot need, told before it shuffles them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import BROADCAST_BYTES, scan_bytes

MARKS = 1 << 28  # bits, in bitmaps of 32,768: 32 MB to broadcast at most, whatever the tables hold


def told(rows: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """``rows`` with ``_perhaps``: true where ``wanted`` has their ``keys``, and for few others.

    Null keys are equal. The keys must have the same types on both sides.
    """
    mark = F.pmod(F.xxhash64(*keys), F.lit(MARKS)) + 1
    bitmaps = wanted.select(mark.alias("_mark")).groupBy(F.bitmap_bucket_number("_mark").alias("_bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_mark")).alias("_bits"))
    place = F.bitmap_bit_position("_mark").cast("int")
    byte = F.ascii(F.decode(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1)), "ISO-8859-1"))
    found = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1
    return (rows.withColumn("_mark", mark).withColumn("_bitmap", F.bitmap_bucket_number("_mark"))
            .join(F.broadcast(bitmaps), "_bitmap", "left")
            .select(*rows.columns, F.coalesce(found, F.lit(False)).alias("_perhaps")))


def with_keys(rows: DataFrame, keys: Sequence[str], wanted: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose ``keys`` ``wanted`` has, or with ``left_anti`` has not; null keys are equal.

    For a semi-join few other rows are shuffled.
    """
    other = wanted.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    if scan_bytes(wanted) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(other), same, how)
    if how == "left_semi":
        rows = told(rows, keys, wanted).where("_perhaps").drop("_perhaps")
    return rows.join(other, same, how)
