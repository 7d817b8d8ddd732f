
from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from checks import stored  # noqa: E402
from checks.oracle import ORACLE  # noqa: E402
from quaymart.functions import dates, text  # noqa: E402
from quaymart.operators import lookups, pricing, scopes, versions  # noqa: E402
from quaymart.operators.cleaning import normalize, rename, require, required_ok  # noqa: E402
from quaymart.operators.sizing import shared_dir  # noqa: E402
from quaymart.operators.predicates import active_companies, domain_filter  # noqa: E402
from quaymart.plans import forecast, loading, marts, outbound, report  # noqa: E402
from quaymart.plans.given_tables import AS_OF, PARAMS, given_tables  # noqa: E402
from quaymart.schemas import MART_TABLES, with_month  # noqa: E402
from quaymart.sources.geo import fallback_units, geo_units, parse_geo_json, parse_geo_text  # noqa: E402
from quaymart.sources.landing import read_table  # noqa: E402
from quaymart.sources.models import MODELS, read_model  # noqa: E402
from quaymart.streaming.loader import stream_load  # noqa: E402

try:  # the training-data operators are a part that may be left out
    import corpus_pipeline
    from quaymart.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

SMOKE_DIR = "/root/testdata/sf0.001"
REPORT_DAYS = 180
RUN_AT = dt.datetime(2024, 2, 1, 6, 0, 0)
MARK_1, MARK_2 = "2024-01-10 00:00:00", "2024-01-20 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """ABC classes of the smoke tables."""
    return queries()["abc"](spark, SMOKE_DIR)


# Quotients of sums: more decimals, so that a quotient like 117/128 is no rounding tie.
QUOTIENTS = ("turnover_ratio", "days_of_cover")


def _tidy(df: DataFrame) -> DataFrame:
    """Doubles to six decimals, so that the order of additions cannot show."""
    return df.select(*[
        F.round(f.name, 9 if f.name in QUOTIENTS else 6).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _on_tables(build: Callable[[dict], DataFrame]) -> Query:
    return lambda spark, sf_dir: _tidy(build(given_tables(spark, sf_dir)))


# --- versions and lookups ---------------------------------------------------------------------


def _latest_moves(t):
    return t["stock_move"].select(
        "company_id", "product_id", "id", "write_date", "product_uom_qty", "quantity_done", "state", "origin")


def _pairs(t):
    return t["stock_move"].groupBy("company_id", "product_id").agg(F.count(F.lit(1)).alias("moves"))


def _scoped_lookup(t):
    return lookups.with_product(_pairs(t), t["product_product"])


def _template_price(t):
    found = lookups.with_template_price(_scoped_lookup(t), t["product_template"])
    return found.drop("product_default_code")


def _role_locations(t):
    routed = lookups.with_usages(t["stock_move"], t["stock_location"])
    return routed.groupBy("company_id", "src_usage", "dst_usage").agg(F.count(F.lit(1)).alias("moves"))


def _order_join(t):
    joined = lookups.join_orders(t["stock_move"], t["purchase_order"])
    return joined.groupBy("company_id", "partner_id").agg(
        F.count(F.lit(1)).alias("moves"), F.max("date_planned").alias("last_planned"))


# --- predicates, cleaning, prices ---------------------------------------------------------------

DOMAIN = ["&", ["default_code", "ilike", "brand#1"], "|", ["company_id", "=", False],
          ["company_id", "in", [2, 3]], ["id", ">=", 10]]


def _domain_filter(t):
    return domain_filter(t["product_product"], DOMAIN)


def _landing(t):
    """Order lines as landed move-line records, with the gaps the source has."""
    flag = F.col("l_returnflag")
    pair = F.array(F.col("l_partkey").cast("string"), F.lit("Product"))
    return t["lineitem"].select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(flag == "R", F.array().cast("array<string>"))
        .otherwise(F.array((F.col("l_suppkey") % 5 + 1).cast("string"), F.lit("Company"))).alias("company_id"),
        F.when(F.col("l_partkey") % 17 != 0, pair).alias("product_id"),
        F.when(F.col("l_discount") > 0.02, F.col("l_quantity")).alias("quantity"),
        F.array(F.lit("8"), F.lit("Stock")).alias("location_id"),
        F.when(flag != "A", "done").alias("state"),
        F.when(F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
        .when(flag == "N", F.date_format("l_shipdate", "yyyy-MM-dd")).otherwise("soon").alias("date"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("write_date"))


def _normalize(t):
    spec = MODELS["stock.move.line"]
    return rename(normalize(_landing(t), spec.fields), spec.aliases)


def _required_gate(t):
    good, _ = require(_normalize(t), MODELS["stock.move.line"].required)
    return good


def _property_price(t):
    return pricing.property_prices(t["ir_property"], 2, "product.template")


def _template_property_price(t):
    return pricing.template_prices(t["product_template"], t["product_product"], t["ir_property"], 2)


def _price_repair(t):
    costed = pricing.with_property_cost(t["product_template"], t["product_product"], t["ir_property"])
    return pricing.repair_standard_price(costed).select("id", "company_id", "standard_price", "list_price")


def _price_ladder(t):
    return t["product_template"].select(
        "id", "company_id", pricing.price_for("sale").alias("sale_price"),
        pricing.price_for("purchase").alias("purchase_price"))


# --- incremental loading ------------------------------------------------------------------------


def _events(t):
    """The event stream as a versioned raw table; the user is the record."""
    return t["events"].select(
        F.col("user_id").alias("id"), (F.col("user_id") % 5 + 1).alias("company_id"), "event_id", "event_type",
        F.floor(F.col("value") / 50).alias("amount"), F.col("ts").alias("write_date"))


def _landed_files(t, *files: int) -> str:
    """Write the landed move lines as JSON files, as many as their size asks for or as are given; their folder."""
    landing = f"{shared_dir(t['lineitem'].sparkSession)}/landing-{uuid.uuid4().hex}"
    _landing(t).repartition(*files, "id").write.json(f"{landing}/stock.move.line")
    return landing


def _load_model(t):
    """Land, load for two companies, read the raw table back."""
    landing = _landed_files(t)
    spark, root = t["lineitem"].sparkSession, f"{landing}/raw"
    loading.load_model(spark, read_model(spark, landing, "stock.move.line"), "stock.move.line", root,
                       company_ids=[2, 3], copy_shared=True)
    return read_table(spark, root, "stock_move_line")


def _stream_load(t):
    """The same through the file stream, in four batches."""
    landing = _landed_files(t, 4)
    spark, root = t["lineitem"].sparkSession, f"{landing}/raw"
    stream_load(spark, landing, "stock.move.line", root, f"{landing}/checkpoint", company_ids=[2, 3], copy_shared=True,
                files_per_batch=1).awaitTermination()
    return read_table(spark, root, "stock_move_line")


def _marks(t):
    """Marks of companies 1 to 4 before the second cut; company 5 has none yet."""
    old = _events(t).where(f"write_date < TIMESTAMP_NTZ '{MARK_2}' AND company_id < 5")
    return old.groupBy("company_id").agg(F.max("write_date").alias("watermark")).select(
        F.lit("events").alias("model"), "company_id", "watermark")


def _incremental(t):
    return loading.incremental(_events(t), _marks(t), "events")


def _flagged(t):
    fresh = _incremental(t)
    return fresh.withColumn("ok", required_ok(fresh.schema, ["id", "amount", "write_date"]))


def _watermark(t):
    return loading.advance_watermark(_marks(t), loading.load_stats(_flagged(t), "events"))


def _full_refresh(t):
    return loading.full_refresh(_events(t), RUN_AT).select("id", "company_id", "event_id", "write_date")


def _merge_batch(t):
    events, keys = _events(t), ["company_id", "id"]
    first = events.where(f"write_date < TIMESTAMP_NTZ '{MARK_1}'")
    second = events.where(f"write_date >= TIMESTAMP_NTZ '{MARK_1}' AND write_date < TIMESTAMP_NTZ '{MARK_2}'")
    third = events.where(f"write_date >= TIMESTAMP_NTZ '{MARK_2}'")
    merged = versions.latest(first, keys, "write_date")
    for batch in (third, second, third):
        merged = versions.merge_batch(merged, batch, keys, "write_date")
    return merged


# --- scopes -------------------------------------------------------------------------------------


def _top_n_scope(t):
    abc = marts.abc_classification(t, PARAMS)
    series = forecast.monthly_series(t, PARAMS)
    kept = scopes.scope_filter(series, scopes.forecast_scope(abc, "top_n:50"))
    return kept.select("company_id", "product_id", F.size("points").alias("months"))


def _anomaly_windows(t):
    kind = F.when(F.col("o_orderstatus") == "F", "STOCKOUT").when(
        F.col("o_orderstatus") == "O", "SUPPLIER_DELAY").otherwise("SHRINKAGE")
    length = (F.col("o_custkey") % 10).cast("int")
    return t["order_company"].select(
        kind.alias("kind"), F.col("company_id").alias("company"), F.to_date("o_orderdate").alias("date"),
        F.when(length > 0, F.date_add(F.to_date("o_orderdate"), length)).alias("end_date"))


def _window_tag(t):
    rows = t["order_company"].select(
        "o_orderkey", F.col("company_id").alias("company"), F.to_date("o_orderdate").alias("date"))
    return scopes.tag_windows(rows, _anomaly_windows(t))


def _vendor_links(t):
    links = t["lineitem"].select(
        F.col("l_suppkey").alias("partner_id"), F.col("l_partkey").alias("product_tmpl_id"),
        (F.col("l_suppkey") % 3).alias("company_id"))
    products = t["part"].select(
        F.col("p_partkey").alias("product_tmpl_id"), F.col("p_partkey").alias("product_id"),
        F.concat_ws("/", "p_type", "p_brand").alias("category"))
    return links, products


def _category_vendors(t):
    return scopes.category_vendors(*_vendor_links(t), 2)


def _vendors_by_category(t):
    links, products = _vendor_links(t)
    categories = products.select("category").union(t["part"].select(F.concat(F.lit("No "), "p_type")))
    found = scopes.vendors_by_category(links, products, categories, 2)
    return found.select("category", F.size("vendor_ids").cast("bigint").alias("vendors"),
                        F.array_join("vendor_ids", ",").alias("vendor_ids"))


# --- outbound rows ------------------------------------------------------------------------------


def _tickets(t):
    anomalies = marts.cost_anomalies(t, PARAMS)
    existing = t["part"].select(
        F.format_string("COGS anomaly product %d", "p_partkey").alias("name"),
        F.when(F.col("p_size") > 25, F.lit(AS_OF)).otherwise(F.date_sub(F.lit(AS_OF), 1))
        .cast("timestamp_ntz").alias("create_date"))
    return outbound.anomaly_tickets(anomalies, existing, PARAMS)


# --- movement report ----------------------------------------------------------------------------


def _report_moves(t):
    kind = F.when(F.col("location_dest_id") == 2, "OUT").when(F.col("location_id") % 10 == 1, "IN").otherwise("INT")
    return t["stock_move_raw"].where("state = 'done'").select(
        "origin", F.col("company_id").alias("company"), kind.alias("kind"),
        F.col("date_done").alias("scheduled_date"), F.col("product_id").alias("product"),
        F.col("product_uom_qty").alias("qty_requested"), F.col("quantity_done").alias("qty_done"),
        F.col("location_id").alias("source_location_id"), F.col("location_dest_id").alias("dest_location_id"))


def _avg_outbound(t):
    return report.avg_outbound(report.daily_outbound(_report_moves(t)), AS_OF, REPORT_DAYS)


def _ending_stock(t):
    return report.ending_stock(report.ledger_balance(_report_moves(t)))


def _merge_summaries(t):
    """Deliveries before and after the day, each reported alone and then merged."""
    moves, cut = _report_moves(t), F.lit(AS_OF).cast("timestamp_ntz")
    parts = []
    for half in (moves.where(F.col("scheduled_date") < cut), moves.where(F.col("scheduled_date") >= cut)):
        parts += [report.movement_counts(report.picking_headers(half)), report.outbound_totals(half)]
    return report.merge_summaries(*parts)


# --- scalar functions on the given tables -------------------------------------------------------


def _messy_name():
    return F.concat(F.lit("  "), "p_name", F.lit(" / "), F.col("p_brand"), F.lit(" - (x)  "))


def _slug(t):
    return t["part"].select("p_partkey", text.slug(_messy_name()).alias("slug"))


def _place_name(t):
    raw = F.when(F.col("p_partkey") % 2 == 0, F.upper(F.concat("p_name", F.lit("-o'"), "p_type"))).otherwise(
        F.concat(F.lit(" "), "p_name", F.lit("   "), "p_type"))
    return t["part"].select("p_partkey", text.place_name(raw).alias("place"))


def _location_parse(t):
    kind = F.when(F.col("p_size") < 15, "GOOD").when(F.col("p_size") < 30, "TRANSIT").when(
        F.col("p_size") < 40, "DAMAGED").otherwise("OTHER")
    warehouse = F.when(F.col("p_partkey") % 9 == 0, "ELSEWHERE").otherwise(F.upper("p_type"))
    name = F.concat_ws("-", F.upper("p_type"), kind, F.when(F.col("p_partkey") % 10 != 0, F.col("p_brand")),
                       F.when(F.col("p_partkey") % 3 == 0, "EAST"))
    parts = text.location_parts(name, warehouse)
    return t["part"].select("p_partkey", parts["kind"].alias("kind"), parts["base"].alias("base"))


def _document_key(t):
    key = text.document_key(F.lit("d1"), F.lit("ke"), F.concat(F.lit("WH"), "company_id"), F.lit("OUT"),
                            F.col("o_orderdate"), F.col("o_orderkey").cast("int"))
    keyed = t["order_company"].select("o_orderkey", key.alias("document"))
    parts = text.document_parts(F.col("document"))
    return keyed.select("o_orderkey", "document", parts["country"].alias("country"),
                        parts["warehouse"].alias("warehouse"), parts["day"].alias("day"), parts["seq"].alias("seq"))


def _stable_id(t):
    key = F.concat(F.lit("product.product:"), "p_brand", F.lit(":"), "p_partkey")
    return t["part"].select("p_partkey", text.stable_int(key).cast("string").alias("stable_int"),
                            text.stable_id(key).alias("stable_id"))


def _seasonal(t):
    country = F.element_at(F.array(*map(F.lit, ("rw", "KE", "ug"))), (F.col("company_id") % 3 + 1).cast("int"))
    names = ("Seeds", "Fertilizer", "Pesticides", "Tools", "Spare Parts", "Packaging")
    category = F.element_at(F.array(*map(F.lit, names)), (F.col("product_id") % 6 + 1).cast("int"))
    days = t["stock_move_raw"].select(
        country.alias("country"), category.alias("category"), F.to_date("date_done").alias("day")).distinct()
    factor = dates.seasonal_multiplier(F.col("country"), F.col("category"), F.col("day"))
    return days.withColumn("multiplier", factor)


def _weekday(t):
    days = _report_moves(t).select(F.to_date("scheduled_date").alias("day"), F.when(
        F.col("kind") == "OUT", "outbound").when(F.col("kind") == "IN", "inbound").otherwise("internal").alias("kind"))
    return days.distinct().withColumn("multiplier", dates.weekday_multiplier(F.col("kind"), F.col("day")))


def _calendar(t):
    spans = t["orders"].select("o_orderkey", "o_orderdate", (F.col("o_orderkey") % 5 - 1).alias("days"))
    return dates.calendar(spans, "o_orderdate", "days").groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


def _month_partition(t):
    moves = with_month(
        t["stock_move"].select(F.to_date("date_done").alias("month")), MART_TABLES["vendor_rating"])
    return moves.groupBy("p_month", dates.next_month(F.col("month")).alias("next_month")).agg(
        F.count(F.lit(1)).alias("moves"))


# --- geography ----------------------------------------------------------------------------------


def _geo_json(t):
    """One JSON text per part, in list form for odd keys and in map form for even ones."""
    units = F.array(F.concat(F.lit(" "), "p_brand", F.lit(" ")), F.lit(" "), F.upper("p_type"))
    units = F.when(F.col("p_size") > 5, units)
    listed = F.to_json(F.array(F.struct(F.upper("p_name").alias("name"), units.alias("base_units"))))
    mapped = F.to_json(F.create_map(F.col("p_name"), units))
    lines = t["part"].select("p_partkey", F.when(F.col("p_partkey") % 2 == 1, listed).otherwise(mapped).alias("value"))
    return geo_units(parse_geo_json(lines), F.lit("KE"), ["p_partkey"])


def _geo_text(t):
    """One ``Name: [a, b]`` line per part, some of them comments or without a colon."""
    body = F.concat("p_name", F.lit(": ["), "p_brand", F.lit(", , "), "p_type", F.lit(" ]"))
    line = F.when(F.col("p_size") == 1, F.concat(F.lit("# "), body)).when(
        F.col("p_size") == 2, F.col("p_name")).when(
        F.col("p_size") == 3, F.concat("p_name", F.lit(": [ ]"))).otherwise(body)
    lines = t["part"].select("p_partkey", line.alias("value"))
    return geo_units(parse_geo_text(lines), F.lit("rw"), ["p_partkey"])


def _base_units(t):
    country = F.element_at(F.array(*map(F.lit, ("rw", "ke", "ug"))), (F.col("s_nationkey") % 3 + 1).cast("int"))
    made = fallback_units(country, (F.col("s_suppkey") % 4).cast("int"))
    return t["supplier"].select("s_suppkey", F.explode(made).alias("base_unit"))


def queries() -> dict[str, Query]:
    """Every query: (spark, folder of the parquet tables) → DataFrame."""
    builders: dict[str, Callable[[dict], DataFrame]] = {
        "latest_moves": _latest_moves,
        "scoped_lookup": _scoped_lookup,
        "template_price": _template_price,
        "role_locations": _role_locations,
        "order_join": _order_join,
        "liquidation": lambda t: marts.liquidation_candidates(t, PARAMS),
        "vendor_rating": lambda t: marts.vendor_rating(t, PARAMS),
        "touch_ratio": lambda t: marts.touch_ratio(t, PARAMS),
        "stockout_risk": lambda t: marts.stockout_risk(t, PARAMS),
        "turnover": lambda t: marts.inventory_turnover(t, PARAMS),
        "cost_anomalies": lambda t: marts.cost_anomalies(t, PARAMS),
        "abc": lambda t: marts.abc_classification(t, PARAMS),
        "abc_in_slices": lambda t: marts.abc_classification(t, PARAMS, ranges=64),
        "touch_ratio_by_route": lambda t: marts.touch_ratio(t, PARAMS, broadcast_bytes=0),
        "forecast_ma": lambda t: forecast.demand_forecast(t, PARAMS),
        "forecast_holt": lambda t: forecast.demand_forecast(t, PARAMS, method="holt"),
        "forecast_holt_fit": lambda t: forecast.demand_forecast(t, PARAMS, method="holt_fit"),
        "otif_alert": lambda t: outbound.otif_alert(marts.vendor_rating(t, PARAMS), PARAMS),
        "tickets": _tickets,
        "abc_writeback": lambda t: outbound.abc_writeback(
            marts.abc_classification(t, PARAMS), t["product_product"], PARAMS),
        "daily_outbound": lambda t: report.daily_outbound(_report_moves(t)),
        "avg_outbound": _avg_outbound,
        "ending_stock": _ending_stock,
        "days_of_cover": lambda t: report.days_of_cover(_ending_stock(t), _avg_outbound(t)),
        "movement_counts": lambda t: report.movement_counts(report.picking_headers(_report_moves(t))),
        "movement_summary": lambda t: report.movement_summary(_report_moves(t), AS_OF, REPORT_DAYS),
        "merge_summaries": _merge_summaries,
        "on_hand": lambda t: report.on_hand_by_location(t["stock_quant"]),
        "active_companies": lambda t: active_companies(t["res_company"], PARAMS.excluded_company_ids),
        "domain_filter": _domain_filter,
        "normalize": _normalize,
        "required_gate": _required_gate,
        "property_price": _property_price,
        "template_property_price": _template_property_price,
        "price_repair": _price_repair,
        "price_ladder": _price_ladder,
        "incremental": _incremental,
        "watermark": _watermark,
        "full_refresh": _full_refresh,
        "merge_batch": _merge_batch,
        "load_model": _load_model,
        "stream_load": _stream_load,
        "load_twice": lambda t: read_table(t["lineitem"].sparkSession, stored.load_twice(t, _landing), "stock_move_line"),
        "load_twice_log": lambda t: stored.loaded_log(t["lineitem"].sparkSession, stored.load_twice(t, _landing)),
        "load_all": lambda t: stored.load_everything(t, _landing, RUN_AT),
        "merge_stored": stored.merge_stored,
        "append_read": stored.append_read,
        "mart_rerun": lambda t: stored.mart_rerun(t, PARAMS),
        "forecast_rerun": lambda t: stored.forecast_rerun(t, PARAMS),
        "named_tables": stored.named_tables,
        "liquidation_stored": lambda t: stored.liquidation_stored(t, PARAMS, _landing),
        "reset_marks": lambda t: stored.reset_marks(t, _marks(t)),
        "report_csv": lambda t: stored.report_csv(t, _report_moves(t)),
        "named_parameters": lambda t: stored.named_parameters(t, PARAMS),
        "load_stats": lambda t: loading.load_stats(_flagged(t), "events"),
        "window_tag": _window_tag,
        "category_vendors": _category_vendors,
        "vendors_by_category": _vendors_by_category,
        "top_n_scope": _top_n_scope,
        "slug": _slug,
        "place_name": _place_name,
        "location_parse": _location_parse,
        "document_key": _document_key,
        "stable_id": _stable_id,
        "seasonal": _seasonal,
        "weekday": _weekday,
        "calendar": _calendar,
        "month_partition": _month_partition,
        "geo_json": _geo_json,
        "geo_text": _geo_text,
        "base_units": _base_units,
    }
    found = {name: _on_tables(build) for name, build in builders.items()}
    if llm is not None:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL of every query, written from the rules and not from the code above."""
    found = dict(ORACLE)
    if llm is not None:
        found |= llm.ORACLE
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
