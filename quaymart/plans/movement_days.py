"""The last done movement of every product and month, kept up to date as months are rewritten.

A maximum cannot take a value back, but a month can be counted again: a correction that lowers,
moves or removes a date rewrites the months it touches, and only those are reduced anew. Which
ones they are is told by the pointers: the table keeps, for each of its months, the runs of the
lines it was made from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_TABLES
from ..sources.landing import read_months, table_path
from ..sources.pointer import Pointer, children, commit, current, next_run

LINES = "stock_move_line"
NAME = "stock_move_line_days"
DDL = "company_id bigint, product_id bigint, last_day date, p_month string"


def _sources(lines: Pointer) -> dict[str, tuple[str, ...]]:
    return {part: tuple(runs) for part, runs in lines.parts.items()}


def is_fresh(spark: SparkSession, root: str) -> bool:
    """Whether the kept days are those of the lines as they are now."""
    lines = current(spark, table_path(root, LINES))
    return dict(current(spark, table_path(root, NAME)).sources) == _sources(lines)


def refresh(spark: SparkSession, root: str) -> list[str]:
    """Count the months again whose lines were rewritten; the partitions concerned."""
    lines, path = current(spark, table_path(root, LINES)), table_path(root, NAME)
    before, sources = current(spark, path), _sources(lines)
    stale = sorted(part for part in {*sources, *before.sources} if sources.get(part) != before.sources.get(part))
    if not stale:
        return []
    run = next_run(before)
    rows = read_months(spark, root, LINES, Pointer(0, {part: lines.parts[part] for part in stale if part in lines.parts}))
    days = rows.where("state = 'done' AND date_done IS NOT NULL").groupBy("p_month", "company_id", "product_id").agg(
        F.max(F.to_date("date_done")).alias("last_day"))
    folder = f"{path}/run={run}"
    (days.hint("rebalance", "p_month").sortWithinPartitions("p_month", *RAW_TABLES[LINES].keys[:2])
     .write.partitionBy("p_month").parquet(folder))
    made = {part: (run,) for part in children(spark, folder) if part.startswith("p_month=")}
    kept = {part: runs for part, runs in before.parts.items() if part not in stale}
    commit(spark, path, before, {**kept, **made}, {}, sources)
    return stale


def read(spark: SparkSession, root: str) -> DataFrame:
    """(company_id, product_id, last_day, p_month)."""
    path = table_path(root, NAME)
    pointer = current(spark, path)
    folders = [f"{path}/run={run}/{part}" for part, runs in sorted(pointer.parts.items()) for run in runs]
    if not folders:
        return spark.createDataFrame([], DDL)
    found = spark.read.schema(f"{DDL}, run string").option("basePath", path).parquet(*folders)
    return found.drop("run")
