"""The seven marts.

They all read tables with one version per key, reduce the facts to (company, product,
month) or similar by id first, and only then look names and prices up: a lookup is
many-to-one, so the result is the same and far fewer rows are joined.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import (
    join_orders,
    scoped_lookup,
    with_company_name,
    with_product,
    with_template_price,
    with_usages,
)
from ..operators.predicates import exclude_companies, since, until, within
from ..operators.ranking import running_totals
from ..operators.sizing import BROADCAST_BYTES, durable, lookup_join, scan_bytes
from ..params import MartParams

Frames = Mapping[str, DataFrame]
MONEY = "decimal(28,4)"


def done_moves(moves: DataFrame, params: MartParams) -> DataFrame:
    """Done moves of the companies that are not excluded."""
    return exclude_companies(moves.where("state = 'done'"), params.excluded_company_ids)


def dated_moves(moves: DataFrame, params: MartParams) -> DataFrame:
    """Done moves for the monthly marts: all history, or the months from ``from_month`` on."""
    done = done_moves(moves, params)
    return done if params.from_month is None else since(done, "date_done", params.from_month.replace(day=1))


def add_month(moves: DataFrame) -> DataFrame:
    return moves.withColumn("month", F.trunc("date_done", "month"))


def on_hand(t: Frames, params: MartParams) -> DataFrame:
    """(company, product) → quantity at internal locations."""
    quants = exclude_companies(t["stock_quant"], params.excluded_company_ids)
    located = scoped_lookup(
        quants, t["stock_location"], "location_id", {"usage": F.col("usage")},
        fallback_any=False, unique=True, salt_by="id")
    return (located.where("usage = 'internal'")
            .groupBy("company_id", "product_id").agg(F.sum("quantity").alias("on_hand_qty")))


def last_movements(t: Frames, params: MartParams) -> DataFrame:
    """(company, product) → day of the last done movement up to the ``as_of`` day.

    Where the loader keeps the last day of every month (``movement_days``), the lines of the
    ``as_of`` month alone are read besides; else all lines are.
    """
    keys, day = ["company_id", "product_id"], F.to_date("date_done").alias("last_day")
    if "movement_days" not in t:
        days = until(done_moves(t["stock_move_line"], params), "date_done", params.as_of).select(*keys, day)
    else:
        month = f"{params.as_of:%Y%m}"
        lines = done_moves(t["stock_move_line"].where(F.col("p_month") == month), params)
        kept = exclude_companies(t["movement_days"].where(F.col("p_month") < month), params.excluded_company_ids)
        days = kept.select(*keys, "last_day").unionByName(until(lines, "date_done", params.as_of).select(*keys, day))
    return days.groupBy(*keys).agg(F.max("last_day").alias("last_movement_date"))


def liquidation_candidates(t: Frames, params: MartParams) -> DataFrame:
    """Dead stock: products without a done movement for more than ``dead_stock_days`` days."""
    last = last_movements(t, params)
    today = F.lit(params.as_of)
    dead = (last.withColumn("days_since_last_move", F.datediff(today, "last_movement_date"))
            .where(F.col("days_since_last_move") > params.dead_stock_days))
    stocked = lookup_join(dead, on_hand(t, params), ["company_id", "product_id"])
    stocked = stocked.withColumn("on_hand_qty", F.coalesce("on_hand_qty", F.lit(0.0)))
    priced = with_template_price(with_product(stocked, t["product_product"]), t["product_template"])
    return with_company_name(priced, t["res_company"]).select(
        today.alias("snapshot_date"), "company_id", "company_name", "product_id", "product_default_code",
        "last_movement_date", "days_since_last_move", "on_hand_qty", "standard_price",
        (F.col("on_hand_qty") * F.col("standard_price")).alias("value_at_risk"))


def vendor_rating(t: Frames, params: MartParams) -> DataFrame:
    """On-time and in-full shares of receipts per month, company and vendor."""
    done = dated_moves(t["stock_move"], params).where("date_done IS NOT NULL")
    receipts = (with_usages(done, t["stock_location"], strict=True)
                .where("src_usage = 'supplier' AND dst_usage = 'internal'"))
    ordered = add_month(join_orders(receipts, t["purchase_order"]))
    rated = (ordered
             .withColumn("partner_id", F.coalesce("partner_id", F.lit(0)))
             .groupBy("month", "company_id", "partner_id")
             .agg(F.avg(F.when(F.col("date_done") <= F.col("date_planned"), 1.0).otherwise(0.0)).alias("on_time_pct"),
                  F.avg(F.when(F.col("quantity_done") >= F.col("product_uom_qty"), 1.0).otherwise(0.0))
                  .alias("in_full_pct")))
    return with_company_name(rated, t["res_company"]).select(
        "month", "company_id", "company_name", "partner_id", "on_time_pct", "in_full_pct",
        (F.col("on_time_pct") * 0.5 + F.col("in_full_pct") * 0.5).alias("overall_score"))


INTERNAL_TO_CUSTOMER = "src_usage = 'internal' AND dst_usage = 'customer'"


def by_route(
    moves: DataFrame, locations: DataFrame, measures: Mapping[str, Column], *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(month, company, product) with the ``measures`` and both usages, ready to be summed.

    With a location table that can be broadcast the rows are still single moves. With a
    larger one the measures are summed by source and destination first and written down once;
    the usages are looked up for the distinct routes, so that one join shuffles the sums.
    """
    keys = ["month", "company_id", "product_id", "location_id", "location_dest_id"]
    rows = add_month(moves).select(*keys, *[column.alias(name) for name, column in measures.items()])
    if scan_bytes(locations) <= broadcast_bytes:
        return with_usages(rows, locations, salt_by="product_id", broadcast_bytes=broadcast_bytes)
    rows = durable(rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures]))
    places = keys[1:2] + keys[3:]
    # A struct is equal to one with the same nulls, so a route without one of its places is found as well.
    route = F.struct(*places).alias("_route")
    routes = with_usages(
        durable(rows.select(*places).distinct()), locations, salt_by="company_id", broadcast_bytes=broadcast_bytes)
    found = routes.select(route, "src_usage", "dst_usage")
    options = {"salt_by": "product_id", "broadcast_bytes": broadcast_bytes}
    return lookup_join(rows.withColumn("_route", route), found, ["_route"], **options).drop("_route")


def touch_ratio(t: Frames, params: MartParams, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Internal moves per outgoing move, by month, company and product."""
    routed = by_route(
        dated_moves(t["stock_move"], params), t["stock_location"], {"n": F.lit(1)}, broadcast_bytes=broadcast_bytes)
    internal = F.expr("src_usage = 'internal' AND dst_usage = 'internal'")
    counted = routed.groupBy("month", "company_id", "product_id").agg(
        F.sum(F.when(internal, F.col("n")).otherwise(0)).alias("internal_moves"),
        F.sum(F.when(F.col("dst_usage") == "customer", F.col("n")).otherwise(0)).alias("outgoing_moves"))
    named = with_company_name(with_product(counted, t["product_product"]), t["res_company"])
    return named.select(
        "month", "company_id", "company_name", "product_id", "product_default_code",
        "internal_moves", "outgoing_moves",
        F.coalesce(F.try_divide("internal_moves", "outgoing_moves"), F.lit(0.0)).alias("touch_ratio"))


def deliveries(
    t: Frames, params: MartParams, measures: Mapping[str, Column], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Sums of done moves from an internal location to a customer, by month, company and product."""
    done = dated_moves(t["stock_move"], params).where("date_done IS NOT NULL")
    routed = by_route(done, t["stock_location"], measures, broadcast_bytes=broadcast_bytes)
    return routed.where(INTERNAL_TO_CUSTOMER).groupBy("month", "company_id", "product_id").agg(
        *[F.sum(name).alias(name) for name in measures])


def stockout_risk(t: Frames, params: MartParams, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Demand that deliveries did not meet, by month, company and product."""
    short = F.col("quantity_done") < F.col("product_uom_qty")
    summed = deliveries(t, params, {
        "demand_qty": F.col("product_uom_qty"),
        "fulfilled_qty": F.col("quantity_done"),
        "unmet_qty": F.when(short, F.col("product_uom_qty") - F.col("quantity_done")).otherwise(F.lit(0.0)),
        "move_count": F.lit(1),
        "stockout_moves": F.when(short, 1).otherwise(0),
    }, broadcast_bytes)
    named = with_company_name(with_product(summed, t["product_product"]), t["res_company"])
    return named.select(
        "month", "company_id", "company_name", "product_id", "product_default_code", "demand_qty",
        "fulfilled_qty", "unmet_qty", "move_count", "stockout_moves",
        F.coalesce(F.try_divide("stockout_moves", "move_count"), F.lit(0.0)).alias("stockout_rate"))


def inventory_turnover(t: Frames, params: MartParams, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Value delivered per month against the value on hand, both at standard price."""
    moved = deliveries(t, params, {"moved_qty": F.col("quantity_done")}, broadcast_bytes)
    stocked = lookup_join(moved, on_hand(t, params), ["company_id", "product_id"])
    priced = with_template_price(with_product(stocked, t["product_product"]), t["product_template"])
    valued = (with_company_name(priced, t["res_company"])
              .withColumn("on_hand_qty", F.coalesce("on_hand_qty", F.lit(0.0)))
              .withColumn("moved_value", F.col("moved_qty") * F.col("standard_price"))
              .withColumn("on_hand_value", F.col("on_hand_qty") * F.col("standard_price")))
    return valued.select(
        "month", "company_id", "company_name", "product_id", "product_default_code", "moved_qty", "moved_value",
        "on_hand_qty", "on_hand_value",
        F.coalesce(F.try_divide("moved_value", "on_hand_value"), F.lit(0.0)).alias("turnover_ratio"))


def cost_anomalies(t: Frames, params: MartParams) -> DataFrame:
    """Products whose unit cost today is off their 30-day average by more than ``anomaly_pct``."""
    layers = exclude_companies(t["stock_valuation_layer"], params.excluded_company_ids)
    recent = within(layers, "create_date", params.as_of, days=30).where("quantity > 0")
    unit = F.try_divide("value", "quantity")
    today = F.to_date("create_date") == F.lit(params.as_of)
    costs = recent.groupBy("company_id", "product_id").agg(
        F.avg(F.when(today, unit)).alias("unit_cost"), F.avg(unit).alias("avg_30d_cost"))
    # No cost today leaves the deviation NULL and the row out; an average of 0 makes it 0.
    off = costs.withColumn("deviation_pct", F.when(F.col("avg_30d_cost") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("unit_cost") - F.col("avg_30d_cost"), F.col("avg_30d_cost"))))
    flagged = off.where(F.abs("deviation_pct") > params.anomaly_pct)
    named = with_company_name(with_product(flagged, t["product_product"]), t["res_company"])
    return named.select(
        F.lit(params.as_of).alias("snapshot_date"), "company_id", "company_name", "product_id",
        "product_default_code", "unit_cost", "avg_30d_cost", "deviation_pct")


def moved_quantities(t: Frames, params: MartParams) -> DataFrame:
    """(company, product) → quantity moved in the last 12 months, in any direction."""
    moves = within(done_moves(t["stock_move"], params), "date_done", params.as_of, months=12)
    return moves.groupBy("company_id", "product_id").agg(F.sum("quantity_done").alias("qty"))


def abc_classification(
    t: Frames,
    params: MartParams,
    *,
    moved: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Pareto classes by the value moved in the last 12 months, ranked inside each company.

    The share includes the product itself, so a company's only product is class C. ``moved``
    passes in :func:`moved_quantities` where a caller has them already, ``ranges`` is the
    number of ranges the running sum is cut into.
    """
    moved = moved_quantities(t, params) if moved is None else moved
    priced = with_template_price(with_product(moved, t["product_product"]), t["product_template"])
    # Money as exact decimals: the running sum must not depend on the order of additions.
    valued = priced.select(
        "company_id", "product_id", "product_default_code",
        F.coalesce((F.col("qty") * F.col("standard_price")).cast(MONEY), F.lit(0).cast(MONEY)).alias("value"))
    ranked = running_totals(valued, "company_id", "value", ["product_id"], ranges=ranges)
    share = F.try_divide(F.col("running").cast("double"), F.col("total").cast("double"))
    shared = with_company_name(ranked.withColumn("cumulative_share", share), t["res_company"])
    return shared.select(
        F.lit(params.as_of).alias("snapshot_date"), "company_id", "company_name", "product_id",
        "product_default_code", F.col("value").cast("double").alias("total_value_moved"), "cumulative_share",
        F.when(F.col("cumulative_share") <= params.abc_a_pct, "A")
        .when(F.col("cumulative_share") <= params.abc_a_pct + params.abc_b_pct, "B")
        .otherwise("C").alias("abc_class"))
