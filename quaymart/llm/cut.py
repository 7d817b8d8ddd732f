"""Cut points that also free the disk of what led to them."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..operators.sizing import shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[int, list] = {}  # by session: writes under way and the setting before them


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark removes shuffle files as soon as a query ends, until the last of nested or parallel uses is over."""
    key = id(spark._jsparkSession)
    with _lock:
        state = _writing.setdefault(key, [0, spark.conf.get(_CLEANUP, "false")])
        state[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            state[0] -= 1
            if not state[0]:
                spark.conf.set(_CLEANUP, _writing.pop(key)[1])


def cut(df: DataFrame) -> DataFrame:
    """Like ``durable``, but shuffle files go as soon as the table is written.

    They would otherwise lie there until the driver collects its garbage, next to those of
    the steps that follow.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quaymart-{uuid.uuid4().hex}"
    with _freed_shuffles(spark):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._cut_folder = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of :func:`cut` that every later step has read already."""
    for table in tables:
        folder = table.__dict__.get("_cut_folder")
        if folder:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
