"""Demand forecast for the month after the last observed one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import LOWER_CI, UPPER_CI
from ..operators.forecasting import average_forecast, fitted_trend_forecast, holt_forecast
from ..operators.lookups import with_company_name, with_product
from ..operators.predicates import within
from ..operators.scopes import forecast_scope, scope_filter
from ..params import MartParams
from .marts import Frames, abc_classification, add_month, done_moves


def monthly_series(t: Frames, params: MartParams) -> DataFrame:
    """(company, product) → monthly done quantities of the last 12 months, oldest first.

    Summed by month before the series is put together, so a series never holds more than
    the 13 months the window touches. Months without moves are not filled in.
    """
    moves = within(done_moves(t["stock_move"], params), "date_done", params.as_of, months=12)
    monthly = add_month(moves).groupBy("company_id", "product_id", "month").agg(
        F.sum("quantity_done").alias("qty"))
    points = F.sort_array(F.collect_list(F.struct("month", F.coalesce("qty", F.lit(0.0)).alias("qty"))))
    return monthly.groupBy("company_id", "product_id").agg(points.alias("points"))


def demand_forecast(
    t: Frames, params: MartParams, *, abc: DataFrame | None = None, method: str = "average"
) -> DataFrame:
    """Forecast per (company, product) in scope, with a ±15 % interval.

    ``abc`` is the ABC mart, of which the snapshot of the day counts. Without it the classes
    come from the sums of the series themselves. ``holt`` takes its factors from a fixed grid, ``holt_fit``
    fits factors and start state; both fall back to the average where a series is too short.
    """
    series = monthly_series(t, params)
    if abc is None:
        total = F.aggregate("points", F.lit(0.0), lambda qty, point: qty + point["qty"])
        moved = series.select("company_id", "product_id", total.alias("qty"))
        abc = abc_classification(t, params, moved=moved)
    abc = abc.where(F.col("snapshot_date") == F.lit(params.as_of))
    series = scope_filter(series, forecast_scope(abc, params.forecast_scope))
    qtys = F.transform("points", lambda point: point["qty"])
    quantity = average_forecast(qtys)
    if method == "holt":
        quantity = F.coalesce(holt_forecast(qtys), quantity)
    elif method == "holt_fit":
        quantity = F.coalesce(fitted_trend_forecast(qtys), quantity)
    forecast = series.select(
        "company_id", "product_id",
        F.add_months(F.element_at("points", -1)["month"], 1).alias("forecast_month"),
        quantity.alias("forecast_qty"))
    named = with_company_name(with_product(forecast, t["product_product"]), t["res_company"])
    return named.select(
        "forecast_month", "company_id", "company_name", "product_id", "product_default_code", "forecast_qty",
        (F.col("forecast_qty") * LOWER_CI).alias("lower_ci"),
        (F.col("forecast_qty") * UPPER_CI).alias("upper_ci"))
