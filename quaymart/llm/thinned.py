"""Rows that a join cannot need, left out before it shuffles them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 18  # numbers of 64 hash bits, a power of two


def told(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` with ``perhaps``: true where ``wanted`` has their ``keys``, and for few others.

    The hash bits of the wanted keys are a table of at most ``SLOTS`` rows whatever the corpus
    holds, so it may be broadcast. The keys must have the same types on both sides.
    """
    slot, bit = F.col("_hash").bitwiseAND(F.lit(SLOTS - 1)), F.shiftrightunsigned("_hash", 58).cast("int")
    marks = wanted.select(F.xxhash64(*keys).alias("_hash")).groupBy(slot.alias("_slot")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_marks"))
    found = F.call_function("shiftrightunsigned", F.col("_marks"), bit).bitwiseAND(F.lit(1)) == 1
    return rows.withColumn("_hash", F.xxhash64(*keys)).withColumn("_slot", slot).join(
        F.broadcast(marks), "_slot", "left").select(*rows.columns, F.coalesce(found, F.lit(False)).alias("perhaps"))


def thinned(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``keys`` ``wanted`` has not; none that it has goes."""
    return told(rows, keys, wanted).where("perhaps").drop("perhaps")
