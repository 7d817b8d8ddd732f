"""CSV output of the movement report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..plans.report import picking_headers

LEVELS = ["country", "dataset"]


def write_report_csv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A header line per file; with ``by``, a folder for each value, of which those that have rows are replaced.

    Spark escapes in a folder's name what a path cannot hold.
    """
    writer = df.write.mode("overwrite").option("header", True)
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.csv(path)


def write_reports(moves: DataFrame, root: str, country: str, dataset: str) -> tuple[str, str]:
    """Document headers and movement lines of one country and dataset key."""
    pickings = f"{root.rstrip('/')}/pickings_{country}_{dataset}"
    lines = f"{root.rstrip('/')}/moves_{country}_{dataset}"
    write_report_csv(picking_headers(moves), pickings)
    write_report_csv(moves, lines)
    return pickings, lines


def write_all_reports(moves: DataFrame, root: str) -> tuple[str, str]:
    """The same for all countries and datasets of ``moves`` at once, from its columns of these names.

    Rows are dealt by country, dataset and document, so that a large country is several files
    and its documents are counted together.
    """
    pickings, lines = f"{root.rstrip('/')}/pickings", f"{root.rstrip('/')}/moves"
    write_report_csv(picking_headers(moves, LEVELS).hint("rebalance", *LEVELS), pickings, LEVELS)
    write_report_csv(moves.hint("rebalance", *LEVELS), lines, LEVELS)
    return pickings, lines
