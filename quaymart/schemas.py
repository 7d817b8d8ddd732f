"""Declared schemas of the raw and mart tables; nothing is ever inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """Columns with their Spark types, the version-dedupe key and the month partition source."""

    columns: dict[str, str]
    keys: tuple[str, ...]
    version: str | None = None
    month_of: str | None = None

    @property
    def ddl(self) -> str:
        return ", ".join(f"{name} {dtype}" for name, dtype in self.columns.items())


_ID, _QTY, _TEXT, _TIME, _INT, _DAY = "bigint", "double", "string", "timestamp_ntz", "int", "date"
_STAMPS = {"write_date": _TIME, "create_date": _TIME}

RAW_TABLES: dict[str, TableSpec] = {
    "stock_move_line": TableSpec(
        {"id": _ID, "company_id": _ID, "product_id": _ID, "qty_done": _QTY, "location_id": _ID,
         "location_dest_id": _ID, "state": _TEXT, "date_done": _TIME, **_STAMPS},
        ("company_id", "product_id", "id"), "write_date", "date_done"),
    "stock_quant": TableSpec(
        {"id": _ID, "company_id": _ID, "product_id": _ID, "location_id": _ID, "quantity": _QTY,
         "reserved_quantity": _QTY, **_STAMPS},
        ("company_id", "product_id", "id"), "write_date"),
    "stock_move": TableSpec(
        {"id": _ID, "company_id": _ID, "product_id": _ID, "product_uom_qty": _QTY, "quantity_done": _QTY,
         "location_id": _ID, "location_dest_id": _ID, "state": _TEXT, "date_expected": _TIME,
         "date_done": _TIME, "origin": _TEXT, **_STAMPS},
        ("company_id", "product_id", "id"), "write_date", "date_done"),
    "purchase_order": TableSpec(
        {"id": _ID, "company_id": _ID, "partner_id": _ID, "name": _TEXT, "date_order": _TIME,
         "date_planned": _TIME, "state": _TEXT, **_STAMPS},
        ("company_id", "partner_id", "id"), "write_date", "date_order"),
    "product_product": TableSpec(
        {"id": _ID, "company_id": _ID, "product_tmpl_id": _ID, "default_code": _TEXT, "active": _INT, **_STAMPS},
        ("company_id", "product_tmpl_id", "id"), "write_date"),
    "product_template": TableSpec(
        {"id": _ID, "company_id": _ID, "name": _TEXT, "standard_price": _QTY, "list_price": _QTY,
         "type": _TEXT, **_STAMPS},
        ("company_id", "id"), "write_date"),
    "stock_valuation_layer": TableSpec(
        {"id": _ID, "company_id": _ID, "product_id": _ID, "quantity": _QTY, "value": _QTY,
         "stock_move_id": _ID, "create_date": _TIME, "write_date": _TIME},
        ("company_id", "product_id", "id"), "write_date", "create_date"),
    "stock_location": TableSpec(
        {"id": _ID, "company_id": _ID, "name": _TEXT, "usage": _TEXT, **_STAMPS},
        ("company_id", "id"), "write_date"),
    "res_company": TableSpec({"id": _ID, "name": _TEXT, **_STAMPS}, ("id",), "write_date"),
    "res_partner": TableSpec(
        {"id": _ID, "company_id": _ID, "name": _TEXT, "supplier_rank": _ID, **_STAMPS},
        ("company_id", "id"), "write_date"),
}

_NAMED = {"company_id": _ID, "company_name": _TEXT}
_ITEM = {**_NAMED, "product_id": _ID, "product_default_code": _TEXT}

MART_TABLES: dict[str, TableSpec] = {
    "liquidation_candidates": TableSpec(
        {"snapshot_date": _DAY, **_ITEM, "last_movement_date": _DAY, "days_since_last_move": _INT,
         "on_hand_qty": _QTY, "standard_price": _QTY, "value_at_risk": _QTY},
        ("company_id", "product_id", "snapshot_date"), month_of="snapshot_date"),
    "vendor_rating": TableSpec(
        {"month": _DAY, **_NAMED, "partner_id": _ID, "on_time_pct": _QTY, "in_full_pct": _QTY,
         "overall_score": _QTY},
        ("company_id", "partner_id", "month"), month_of="month"),
    "warehouse_touch_ratio": TableSpec(
        {"month": _DAY, **_ITEM, "internal_moves": _ID, "outgoing_moves": _ID, "touch_ratio": _QTY},
        ("company_id", "product_id", "month"), month_of="month"),
    "stockout_risk": TableSpec(
        {"month": _DAY, **_ITEM, "demand_qty": _QTY, "fulfilled_qty": _QTY, "unmet_qty": _QTY,
         "move_count": _ID, "stockout_moves": _ID, "stockout_rate": _QTY},
        ("company_id", "product_id", "month"), month_of="month"),
    "inventory_turnover": TableSpec(
        {"month": _DAY, **_ITEM, "moved_qty": _QTY, "moved_value": _QTY, "on_hand_qty": _QTY,
         "on_hand_value": _QTY, "turnover_ratio": _QTY},
        ("company_id", "product_id", "month"), month_of="month"),
    "cost_anomalies": TableSpec(
        {"snapshot_date": _DAY, **_ITEM, "unit_cost": _QTY, "avg_30d_cost": _QTY, "deviation_pct": _QTY},
        ("company_id", "product_id", "snapshot_date"), month_of="snapshot_date"),
    "abc_classification": TableSpec(
        {"snapshot_date": _DAY, **_ITEM, "total_value_moved": _QTY, "cumulative_share": _QTY,
         "abc_class": _TEXT},
        ("company_id", "product_id", "snapshot_date"), month_of="snapshot_date"),
    "demand_forecast": TableSpec(
        {"forecast_month": _DAY, **_ITEM, "forecast_qty": _QTY, "lower_ci": _QTY, "upper_ci": _QTY},
        ("company_id", "product_id", "forecast_month"), month_of="forecast_month"),
}


def enforce_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project to the declared columns and types; a column the input lacks becomes a typed NULL."""
    have = set(df.columns)
    return df.select(*[
        (F.col(name) if name in have else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in spec.columns.items()
    ])


def with_month(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the ``p_month`` partition column (yyyyMM) where the table has one."""
    if spec.month_of is None:
        return df
    return df.withColumn("p_month", F.date_format(F.col(spec.month_of), "yyyyMM"))
