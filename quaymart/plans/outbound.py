"""Rows that go back out: the score alert, anomaly tickets, ABC classes per template."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import percent
from ..operators.scopes import new_tickets
from ..params import MartParams


def otif_alert(vendor_rating: DataFrame, params: MartParams) -> DataFrame:
    """One row: this month's lowest score, and whether it is below the threshold.

    No score, or nobody to write to, means no alert.
    """
    month = F.trunc(F.lit(params.as_of), "month")
    lowest = vendor_rating.where(F.col("month") == month).agg(F.min("overall_score").alias("min_score"))
    below = F.coalesce(F.col("min_score") < params.otif_threshold, F.lit(False))
    return lowest.select(
        month.alias("month"), "min_score", (below & F.lit(bool(params.alert_email))).alias("alert"))


def anomaly_tickets(anomalies: DataFrame, existing: DataFrame, params: MartParams) -> DataFrame:
    """Tickets for today's cost anomalies: one per product and day, none without a team."""
    today = anomalies.where(F.col("snapshot_date") == F.lit(params.as_of))
    if params.helpdesk_team_id is None:
        today = today.where(F.lit(False))
    # The subject names the product only, so several companies share one ticket.
    first = today.groupBy("product_id").agg(F.min_by("deviation_pct", "company_id").alias("deviation_pct"))
    tickets = first.select(
        F.format_string("COGS anomaly product %d", "product_id").alias("name"),
        F.format_string("Check item %d. Cost deviated %s from 30-day average.",
                        "product_id", percent(F.col("deviation_pct"))).alias("description"),
        F.lit(params.helpdesk_team_id).cast("bigint").alias("team_id"))
    return new_tickets(tickets, existing, params.as_of)


def abc_writeback(abc: DataFrame, products: DataFrame, params: MartParams) -> DataFrame:
    """(product_tmpl_id, abc_class) of the day's snapshot; the best class of a template's variants."""
    today = abc.where(F.col("snapshot_date") == F.lit(params.as_of))
    best = today.groupBy("product_id").agg(F.min("abc_class").alias("abc_class"))
    variants = products.select(F.col("id").alias("product_id"), "product_tmpl_id").distinct()
    return (best.join(variants, "product_id")
            .where(F.coalesce("product_tmpl_id", F.lit(0)) != 0)
            .groupBy("product_tmpl_id").agg(F.min("abc_class").alias("abc_class")))
