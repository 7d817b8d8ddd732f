"""Movement report: outbound by day, average demand, ledger stock, days of cover, summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_n

HEADER = ["origin", "company", "warehouse", "kind", "scheduled_date", "source_location_id",
          "dest_location_id", "note"]


def picking_headers(moves: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per document with its number of lines, for each value of ``by`` apart."""
    keys = [*by, *[c for c in HEADER if c in moves.columns]]
    return moves.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines"))


def movement_counts(pickings: DataFrame) -> DataFrame:
    """kind → number of documents."""
    return pickings.groupBy("kind").agg(F.count(F.lit(1)).alias("pickings"))


def daily_outbound(moves: DataFrame) -> DataFrame:
    """(day, product) → quantity sent out."""
    return (moves.where("kind = 'OUT'")
            .groupBy(F.to_date("scheduled_date").alias("day"), "product")
            .agg(F.sum("qty_done").alias("qty")))


def avg_outbound(daily: DataFrame, end_date: dt.date, days: int, window: int = 30) -> DataFrame:
    """product → quantity per day over the last ``window`` of the ``days`` ending at ``end_date``.

    Days without sales count; products without any sale in the window are left out.
    """
    inside, span = _last_days(end_date, days, window)
    return daily.where(inside).groupBy("product").agg((F.sum("qty") / F.lit(span)).alias("rate"))


def _last_days(end_date: dt.date, days: int, window: int) -> tuple[Column, float]:
    """Condition on ``day`` and the number of days to divide by."""
    span = max(0, min(window, days))
    start = end_date - dt.timedelta(days=span)
    return (F.col("day") > F.lit(start)) & (F.col("day") <= F.lit(end_date)), float(max(1, span))


def postings(moves: DataFrame) -> DataFrame:
    """Two ledger rows per move that moved anything: minus at the source, plus at the destination."""
    both = F.array(
        F.struct(F.col("source_location_id").alias("location_id"), (-F.col("qty_done")).alias("qty")),
        F.struct(F.col("dest_location_id").alias("location_id"), F.col("qty_done").alias("qty")))
    return moves.where("qty_done > 0").select("product", F.inline(both))


def ledger_balance(moves: DataFrame) -> DataFrame:
    """(location, product) → balance."""
    return postings(moves).groupBy("location_id", "product").agg(F.sum("qty").alias("balance"))


def ending_stock(balance: DataFrame, locations: Sequence[int] | None = None) -> DataFrame:
    """product → sum of its positive balances, at every location unless ``locations`` narrows it."""
    if locations is not None:
        balance = balance.where(F.col("location_id").isin(*locations))
    return balance.where("balance > 0").groupBy("product").agg(F.sum("balance").alias("stock"))


def days_of_cover(stock: DataFrame, rate: DataFrame) -> DataFrame:
    """Days the stock lasts at the average rate, for products with a rate; no stock counts as 0."""
    held = F.coalesce("stock", F.lit(0.0))
    return rate.where("rate > 0").join(stock, "product", "left").select(
        "product", held.alias("stock"), "rate", F.try_divide(held, "rate").alias("days_of_cover"))


def outbound_totals(moves: DataFrame) -> DataFrame:
    return moves.where("kind = 'OUT'").groupBy("product").agg(F.sum("qty_done").alias("qty"))


def movement_summary(moves: DataFrame, end_date: dt.date, days: int, window: int = 30) -> DataFrame:
    """The report as rows: document counts, top 10 outbound products, lowest 10 days of cover.

    Totals and rates both come from the daily sums, whose shuffle they share.
    """
    daily = daily_outbound(moves)
    counts = _picking_rows(movement_counts(picking_headers(moves)))
    top = _top_outbound(daily.groupBy("product").agg(F.sum("qty").alias("qty")))
    inside, span = _last_days(end_date, days, window)
    rate = daily.groupBy("product").agg((F.sum(F.when(inside, F.col("qty"))) / F.lit(span)).alias("rate"))
    cover = days_of_cover(ending_stock(ledger_balance(moves)), rate)
    low = top_n(cover, [F.col("days_of_cover").asc(), F.col("product").asc()], 10).select(
        F.lit("lowest_days_of_cover").alias("section"), F.col("product").cast("string").alias("item"),
        F.col("days_of_cover").alias("amount"))
    return counts.unionByName(top).unionByName(low)


def _picking_rows(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.lit("picking_count").alias("section"), F.col("kind").alias("item"),
        F.col("pickings").cast("double").alias("amount"))


def _top_outbound(totals: DataFrame) -> DataFrame:
    return top_n(totals, [F.col("qty").desc(), F.col("product").asc()], 10).select(
        F.lit("top_outbound").alias("section"), F.col("product").cast("string").alias("item"),
        F.col("qty").alias("amount"))


def merge_summaries(
    counts_a: DataFrame, totals_a: DataFrame, counts_b: DataFrame, totals_b: DataFrame
) -> DataFrame:
    """Two reports as one: counts added by kind, outbound totals added in full and then cut to 10."""
    counts = counts_a.unionByName(counts_b).groupBy("kind").agg(F.sum("pickings").alias("pickings"))
    totals = totals_a.unionByName(totals_b).groupBy("product").agg(F.sum("qty").alias("qty"))
    return _picking_rows(counts).unionByName(_top_outbound(totals))


def on_hand_by_location(
    quants: DataFrame, locations: DataFrame | None = None, products: DataFrame | None = None
) -> DataFrame:
    """(location, product) → quantity on hand, for the given locations and products (all if not given)."""
    if locations is not None:
        quants = quants.join(locations.select("location_id").distinct(), "location_id", "left_semi")
    if products is not None:
        quants = quants.join(products.select("product_id").distinct(), "product_id", "left_semi")
    return quants.groupBy("location_id", "product_id").agg(
        F.sum(F.coalesce("quantity", F.lit(0.0))).alias("qty"))
