"""Size checks that decide between a broadcast and a shuffle, and durable cut points."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Compressed input bytes up to which a lookup side may be broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024
# Hot keys the sketch tells apart at most, per shuffle partition; it counts this many times more.
SKETCH_FACTOR = 8


def scan_bytes(df: DataFrame) -> int:
    """Bytes of the tables the plan reads, from Catalyst's statistics; plans and runs nothing.

    Leaves without statistics count as very large.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        total += int(str(leaves.next().stats().sizeInBytes()))
    return total


def broadcast_if_small(df: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast where the size check allows it, else leave the join to Spark."""
    return F.broadcast(df) if scan_bytes(df) <= broadcast_bytes else df


def heavy_hitters(fact: DataFrame, on: list[str] | list[Column]) -> dict[int, int]:
    """Hash of every key with more rows than an average task → the tasks it needs.

    One pass over the key columns feeds a frequent-items sketch in each task. A key is heavy if
    it has more than one part in as many as there are shuffle partitions, so there can be no
    more heavy keys than that, and their parts are at most twice that together.
    """
    parts = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The sketch takes up to 10,000 items of up to 1,000,000 counted; fewer leave keys of a smaller share to the shuffle.
    top, counted = min(parts, 10_000), min(max(SKETCH_FACTOR * parts, 1000), 1_000_000)
    row = fact.select(F.xxhash64(*on).alias("k")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(k, {top}, {counted})").alias("top")).first()
    if not row["rows"]:
        return {}
    share = row["rows"] / parts
    return {item["item"]: math.ceil(item["count"] / share) for item in row["top"] if item["count"] > share}


def hashed_alike(fact: DataFrame, dim: DataFrame, on: list[str]) -> list[Column] | None:
    """The keys as columns whose hashes agree where the keys do, on either side; None if that is not sure.

    A hash depends on the type: an int 1 and a bigint 1 are equal to a join but not to ``xxhash64``.
    """
    keys = []
    for name in on:
        kinds = fact.schema[name].dataType, dim.schema[name].dataType
        if kinds[0] == kinds[1]:
            keys.append(F.col(name))
        elif all(isinstance(kind, T.IntegralType) for kind in kinds):
            keys.append(F.col(name).cast("bigint"))
        else:
            return None
    return keys


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    *,
    salt_by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join to a lookup that is unique on ``on``.

    A lookup read from at most ``broadcast_bytes`` is broadcast; its keys are distinct, so
    the bytes of the table bound its rows. A larger one is joined by shuffle; ``salt_by``
    names a column of the fact by which the rows of its heavy keys are spread, each over as
    many tasks as it has rows for, and only those keys' lookup rows are copied. The salt is a
    hash of the row, never random, so a recomputed task sends its rows to the same place.
    Finding the heavy keys reads the fact's key columns once more. Keys of types that only the
    join knows to compare, as a text with a number, are left to adaptive execution.
    """
    if scan_bytes(dim) <= broadcast_bytes:
        return fact.join(F.broadcast(dim), on, "left")
    keys = hashed_alike(fact, dim, on) if salt_by is not None else None
    heavy = heavy_hitters(fact, keys) if keys is not None else {}
    if not heavy:
        return fact.join(dim, on, "left")
    parts = F.create_map(*[F.lit(x).cast(kind) for pair in heavy.items() for x, kind in zip(pair, ("bigint", "int"), strict=True)])
    copies = F.coalesce(F.try_element_at(parts, F.xxhash64(*keys)), F.lit(1))
    salted_fact = fact.withColumn("_salt", F.pmod(F.xxhash64(salt_by), copies).cast("int"))
    salted_dim = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return salted_fact.join(salted_dim, [*on, "_salt"], "left").drop("_salt")


@contextmanager
def shuffles_freed(spark: SparkSession, split_bytes: int | None = None) -> Iterator[None]:
    """Let a write delete its shuffle files when it ends, not when the driver collects its garbage.

    ``split_bytes`` bounds the bytes of files that one of its tasks reads.
    """
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if split_bytes is not None:
        wanted["spark.sql.files.maxPartitionBytes"] = str(split_bytes)
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def durable(df: DataFrame) -> DataFrame:
    """Write to a table in the cluster's shared folder and read that back.

    Cuts the lineage like a checkpoint, computes the rows once, and gives later steps a
    columnar input of known size. A lost executor costs the tasks it held, nothing more.
    """
    path = f"{shared_dir(df.sparkSession)}/quaymart-{uuid.uuid4().hex}"
    with shuffles_freed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local run may make its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="quaymart-"))
    return context.getCheckpointDir()
