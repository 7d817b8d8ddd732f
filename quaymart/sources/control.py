"""High-water marks: an append-only log of (model, company_id, watermark)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import EPOCH
from ..operators.versions import latest
from .landing import exists

STATE = "model string, company_id bigint, watermark timestamp_ntz"
_LOG = f"{STATE}, saved_at timestamp"


def read_watermarks(spark: SparkSession, path: str) -> DataFrame:
    """The mark saved last for every model and company."""
    if not exists(spark, path):
        return spark.createDataFrame([], STATE)
    log = spark.read.schema(_LOG).parquet(path)
    return latest(log, ["model", "company_id"], "saved_at").drop("saved_at")


def save_watermarks(marks: DataFrame, path: str) -> None:
    """Append the marks; a reader takes the newest, so a stopped write leaves the old ones valid."""
    (marks.select("model", "company_id", "watermark", F.current_timestamp().alias("saved_at"))
     .write.mode("append").parquet(path))


def reset_watermarks(state: DataFrame) -> DataFrame:
    """Every mark back to the epoch."""
    return state.withColumn("watermark", F.lit(EPOCH).cast("timestamp_ntz"))
