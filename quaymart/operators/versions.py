"""Newest version per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sizing import durable


def latest(
    df: DataFrame,
    keys: Sequence[str],
    version: str | None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the highest ``version`` per key.

    Equal versions are decided by ``ties``, by default all remaining columns, highest
    first, so the result never depends on row order. Spark limits each map task to one
    row per key before the shuffle, so a key with very many versions stays cheap.
    """
    lead = [version] if version and version in df.columns else []
    rest = [c for c in df.columns if c not in keys and c not in lead] if ties is None else list(ties)
    order = [F.col(c).desc_nulls_last() for c in [*lead, *rest]] or [F.lit(1)]
    # Keys are declared coarse to fine; the sort compares the fine one first and rarely looks further.
    newest = Window.partitionBy(*reversed(keys)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def merge_batch(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    version: str | None,
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Existing rows and a batch as one table with the newest version per key.

    Merging the same batch again changes nothing, and batches may come in any order.
    """
    return latest(existing.unionByName(batch), keys, version, ties)


def merge_distinct(existing: DataFrame, batch: DataFrame, keys: Sequence[str], version: str | None, part: str) -> DataFrame:
    """:func:`merge_batch` of two tables that have every key once, telling what the batch changes; written to a table.

    ``_held`` rows were there already; of equal rows it is that one. The others have in ``_old`` the
    ``part`` of the row that they replace, in a struct, or null where there is none.
    """
    both = existing.withColumns({"_held": F.lit(True), "_old": F.struct(part)}).unionByName(
        batch.withColumns({"_held": F.lit(False), "_old": F.lit(None)}))
    both = both.withColumn("_old", F.max("_old").over(Window.partitionBy(*reversed(keys))))
    rest = [c for c in batch.columns if c not in keys and c not in (version, part)]
    return durable(latest(both, keys, version, [*rest, "_held"]))
