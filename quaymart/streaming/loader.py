"""The loader on a stream of landed files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.predicates import domain_filter
from ..operators.sizing import durable
from ..plans.loading import load_model
from ..sources.models import MODELS, parse_lines, with_file


def stream_load(
    spark: SparkSession,
    landing: str,
    model: str,
    root: str,
    checkpoint: str,
    *,
    company_ids: Sequence[int] | None = None,
    copy_shared: bool = False,
    refresh_at: dt.datetime | None = None,
    products: DataFrame | None = None,
    properties: DataFrame | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Load every file not loaded before, then stop.

    The stream's checkpoint remembers the files, which makes the high-water mark
    unnecessary. A batch that is run twice merges to the same table. Prices, restamping, the
    run log and the lines that are no JSON are treated as in the batch loader.
    """
    spec = MODELS[model]
    lines = with_file(spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch)
                      .load(f"{landing.rstrip('/')}/{model}"))

    def merge(batch: DataFrame, _batch_id: int) -> None:
        lines = durable(parse_lines(batch, model))  # opened and parsed once, for records and broken lines
        records = domain_filter(lines.where("broken IS NULL").drop("broken", "file"), spec.domain)
        load_model(
            batch.sparkSession, records, model, root, company_ids=company_ids, copy_shared=copy_shared,
            refresh_at=refresh_at, products=products, properties=properties, use_marks=False,
            malformed=lines.where("broken IS NOT NULL").select(F.col("broken").alias("value"), "file"))

    return (lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
