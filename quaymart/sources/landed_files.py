"""A log of the landed files that loads have taken, so that a load opens new and changed ones only.

A file is known by its path, length and time; it counts as taken for the companies whose
records were asked for, so that a company that is added later finds its records in old files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .pointer import exists

LOG = "path string, length bigint, modified timestamp, company_ids array<bigint>"
_FILE = ["path", "length", "modified"]


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, modified) of every file below a folder; none is opened, as its content is not asked for."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listed.select("path", "length", F.col("modificationTime").alias("modified"))


def not_taken(spark: SparkSession, files: DataFrame, log: str, company_ids: Sequence[int]) -> DataFrame:
    """The files that are new, changed, or were not yet read for all of the companies."""
    if not exists(spark, log):
        return files
    wanted = F.array(*[F.lit(i).cast("bigint") for i in sorted(set(company_ids))]).cast("array<bigint>")
    taken = spark.read.schema(LOG).parquet(log).groupBy(*_FILE).agg(
        F.flatten(F.collect_set("company_ids")).alias("ids")).where(F.size(F.array_except(wanted, "ids")) == 0)
    return files.join(taken, _FILE, "left_anti").select(*files.columns)


def note_taken(files: DataFrame, log: str, company_ids: Sequence[int]) -> None:
    """Log files as read; done last, so that a load that stops reads them again."""
    ids = F.array(*[F.lit(i).cast("bigint") for i in sorted(set(company_ids))]).cast("array<bigint>")
    files.select(*_FILE, ids.alias("company_ids")).write.mode("append").parquet(log)
