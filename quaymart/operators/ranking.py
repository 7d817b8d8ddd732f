"""Ordered results: shares of a running total and global top-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import durable


def running_totals(
    df: DataFrame, group: str, value: str, ties: Sequence[str], *, ranges: int | None = None
) -> DataFrame:
    """Add ``running`` (sum of ``value`` so far, largest first, then by ``ties``) and ``total`` per ``group``.

    ``ties`` must be unique inside a group and value. The rows are put into ranges of (group,
    value, ties), whose borders Spark samples, so that a large group and even a run of equal
    values is spread over as many tasks as it needs. A range keeps its own running sum for
    each group in it and starts from the sums of that group in the ranges before, a row for
    each range and group. The ranges are written down, as borders sampled again would differ.
    ``ranges`` is the number of shuffle partitions unless given.
    """
    count = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc(value), *ties]
    placed = durable(df.repartitionByRange(count, group, *order).withColumn("_range", F.spark_partition_id()))
    sums = placed.groupBy("_range", group).agg(F.sum(value).alias("_sum"))
    by_group = Window.partitionBy(group)
    before = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_range", group, F.sum("_sum").over(before).alias("_start"), F.sum("_sum").over(by_group).alias("total"))
    inside = Window.partitionBy("_range", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.withColumn("_inside", F.sum(value).over(inside)).join(starts, ["_range", group], "left")
    return joined.select(
        *df.columns,
        F.when(F.col("_start").isNull(), F.col("_inside"))
        .otherwise(F.col("_inside") + F.col("_start")).alias("running"),
        "total")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall; each task keeps at most ``n`` before they are merged."""
    return df.orderBy(*order).limit(n)
