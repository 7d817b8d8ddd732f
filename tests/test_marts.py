import dataclasses
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quaymart.operators import lookups
from quaymart.operators.ranking import running_totals
from quaymart.params import MartParams
from quaymart.plans import marts
from quaymart.plans.given_tables import PARAMS, given_tables
from quaymart.plans.tables import Tables
from quaymart.schemas import RAW_TABLES
from quaymart.sources.landing import append_table
from tests.conftest import rows_of

AS_OF = dt.date(2024, 6, 15)
P = MartParams(as_of=AS_OF)
NOON = dt.datetime(2024, 6, 15, 12)


@pytest.fixture
def tables(spark):
    """Raw tables from dicts; fields left out are NULL."""
    def build(**rows):
        frames = {}
        for name, spec in RAW_TABLES.items():
            data = [tuple(r.get(c) for c in spec.columns) for r in rows.get(name, [])]
            frames[name] = spark.createDataFrame(data, spec.ddl)
        return Tables.of(**frames)
    return build


def move(i, product=1, company=2, qty=10.0, done=None, src=20, dst=2, when=NOON, **more):
    return {"id": i, "company_id": company, "product_id": product, "product_uom_qty": qty,
            "quantity_done": qty if done is None else done, "location_id": src, "location_dest_id": dst,
            "state": "done", "date_done": when, **more}


PLACES = [
    {"id": 1, "company_id": 0, "usage": "supplier"}, {"id": 2, "company_id": 0, "usage": "customer"},
    {"id": 20, "company_id": 2, "usage": "internal"}, {"id": 21, "company_id": 2, "usage": "supplier"},
    {"id": 30, "company_id": 3, "usage": "internal"},
]
COMMON = {
    "stock_location": PLACES,
    "res_company": [{"id": 2, "name": "Two"}],
    "product_product": [{"id": p, "company_id": 0, "product_tmpl_id": p, "default_code": f"P{p}"} for p in range(1, 9)],
    "product_template": [{"id": p, "company_id": 0, "standard_price": float(p)} for p in range(1, 9)],
}


def test_liquidation_needs_more_than_the_days_and_keeps_products_without_stock(tables):
    ago = lambda n: dt.datetime(2024, 6, 15) - dt.timedelta(days=n)
    lines = [dict(move(i, product=i), qty_done=1.0, date_done=ago(n)) for i, n in ((1, 90), (2, 91), (3, 200))]
    lines += [dict(move(4, product=4, company=9), date_done=ago(300)), dict(move(5, product=3), date_done=ago(95))]
    quants = [{"id": 1, "company_id": 2, "product_id": 2, "location_id": 20, "quantity": 4.0},
              {"id": 2, "company_id": 2, "product_id": 2, "location_id": 2, "quantity": 50.0}]
    t = tables(stock_move_line=lines, stock_quant=quants, **COMMON)
    found = marts.liquidation_candidates(t, MartParams(as_of=AS_OF, excluded_company_ids=(9,)))
    assert rows_of(found, "product_id", "days_since_last_move", "on_hand_qty", "value_at_risk", "company_name") == [
        (2, 91, 4.0, 8.0, "Two"), (3, 95, 0.0, 0.0, "Two")]


def test_vendor_rating_matches_locations_strictly_and_counts_unmatched_orders_late(tables):
    orders = [{"id": 1, "company_id": 2, "partner_id": 7, "name": "PO1", "date_planned": NOON}]
    late = NOON + dt.timedelta(seconds=1)
    moves = [move(1, src=21, dst=20, origin="PO1"), move(2, src=21, dst=20, done=9.0, origin="PO1", when=late),
             move(3, src=21, dst=20, origin="PO9"), move(4, src=1, dst=20, origin="PO1"),
             move(5, src=21, dst=20, origin="PO1", when=None)]
    rated = marts.vendor_rating(tables(stock_move=moves, purchase_order=orders, **COMMON), P)
    assert rows_of(rated, "partner_id", "on_time_pct", "in_full_pct", "overall_score") == [
        (0, 0.0, 1.0, 0.5), (7, 0.5, 0.5, 0.5)]


def test_touch_ratio_is_zero_without_outgoing_moves(tables):
    moves = [move(1, src=20, dst=20), move(2, src=20, dst=20), move(3), move(4, product=2, src=20, dst=20),
             move(5, product=3, src=1, dst=20), move(6, product=4, when=None)]
    found = marts.touch_ratio(tables(stock_move=moves, **COMMON), P)
    assert rows_of(found, "product_id", "internal_moves", "outgoing_moves", "touch_ratio", "month") == [
        (1, 2, 1, 2.0, dt.date(2024, 6, 1)), (2, 1, 0, 0.0, dt.date(2024, 6, 1)),
        (3, 0, 0, 0.0, dt.date(2024, 6, 1)), (4, 0, 1, 0.0, None)]


def test_stockout_risk(tables):
    moves = [move(1, done=4.0), move(2), move(3, done=12.0), move(4, product=2), move(5, src=1)]
    found = marts.stockout_risk(tables(stock_move=moves, **COMMON), P)
    assert rows_of(found, "product_id", "demand_qty", "fulfilled_qty", "unmet_qty", "move_count", "stockout_moves") == [
        (1, 30.0, 26.0, 6.0, 3, 1), (2, 10.0, 10.0, 0.0, 1, 0)]


def test_turnover_guards_an_empty_stock(tables):
    quants = [{"id": 1, "company_id": 2, "product_id": 2, "location_id": 20, "quantity": 4.0}]
    t = tables(stock_move=[move(1), move(2, product=2), move(3, product=2)], stock_quant=quants, **COMMON)
    assert rows_of(marts.inventory_turnover(t, P), "product_id", "moved_value", "on_hand_value", "turnover_ratio") == [
        (1, 10.0, 0.0, 0.0), (2, 40.0, 8.0, 5.0)]


def test_cost_anomalies_skip_empty_quantities_and_products_without_a_cost_today(tables):
    def layer(i, product, value, quantity=1.0, days=0):
        return {"id": i, "company_id": 2, "product_id": product, "quantity": quantity, "value": value,
                "create_date": dt.datetime(2024, 6, 15) - dt.timedelta(days=days)}
    layers = [layer(1, 1, 20.0), layer(2, 1, 10.0, days=30), layer(3, 1, 99.0, days=31), layer(4, 1, 5.0, quantity=0.0),
              layer(5, 2, 10.0), layer(6, 2, 11.0, days=3), layer(7, 3, 10.0, days=3), layer(8, 4, 0.0)]
    found = marts.cost_anomalies(tables(stock_valuation_layer=layers, **COMMON), P)
    assert [(r[0], r[1], r[2], round(r[3], 6)) for r in rows_of(
        found, "product_id", "unit_cost", "avg_30d_cost", "deviation_pct")] == [(1, 20.0, 15.0, 0.333333)]


@pytest.mark.parametrize("steps", [1, 3, 40])
def test_abc_is_inclusive_and_breaks_ties_by_product(tables, steps):
    moves = [move(1, product=1, qty=80.0), move(2, product=5, qty=2.0), move(3, product=2, qty=5.0),
             move(4, product=8, company=3, qty=1.0), move(5, product=1, qty=500.0, when=dt.datetime(2023, 6, 14)),
             move(6, product=7, company=4, qty=0.0)]
    found = marts.abc_classification(tables(stock_move=moves, **COMMON), P, ranges=steps)
    assert rows_of(found, "company_id", "product_id", "cumulative_share", "abc_class") == [
        (2, 1, 0.8, "A"), (2, 2, 0.9, "B"), (2, 5, 1.0, "C"), (3, 8, 1.0, "C"), (4, 7, None, "C")]


def test_running_totals_in_ranges_equal_the_plain_windows(spark, tmp_path):
    # One group has most rows, and most of those the same value.
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, 1).otherwise(F.col("id") % 5).alias("g"), "id",
        F.when(F.col("id") % 3 == 0, F.lit(5)).otherwise(F.col("id") % 1000).cast("decimal(28,4)").alias("v"))
    df = df.withColumn("v", F.when(F.col("id") % 11 == 0, -F.col("v")).otherwise(F.col("v")))
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    whole = Window.partitionBy("g")
    so_far = whole.orderBy(F.desc("v"), "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = stored.select("*", F.sum("v").over(so_far).alias("running"), F.sum("v").over(whole).alias("total"))
    for steps in (1, 4, 30):
        sliced = running_totals(stored, "g", "v", ["id"], ranges=steps)
        assert plain.exceptAll(sliced).count() == 0 and sliced.count() == 20000


DATA = "/root/testdata/sf0.001"
BUILDERS = [marts.liquidation_candidates, marts.vendor_rating, marts.touch_ratio, marts.stockout_risk,
            marts.inventory_turnover, marts.cost_anomalies, marts.abc_classification]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The given tables as the loader keeps them."""
    root = str(tmp_path_factory.mktemp("raw"))
    given = given_tables(spark, DATA)
    for name in RAW_TABLES:
        append_table(given[name], root, name)
    return Tables.from_root(spark, root)


@pytest.mark.parametrize("build", BUILDERS, ids=lambda b: b.__name__)
def test_mart_plans_have_no_pairing_joins(spark, stored, build):
    result = build(stored, PARAMS)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert build(given_tables(spark, DATA), PARAMS).exceptAll(result).count() == 0


@pytest.mark.parametrize("build", [marts.touch_ratio, marts.stockout_risk, marts.inventory_turnover],
                         ids=lambda b: b.__name__)
def test_a_location_table_too_large_to_broadcast_gives_the_same_mart(stored, build):
    small, large = build(stored, PARAMS), build(stored, PARAMS, broadcast_bytes=0)
    plan = large._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert small.exceptAll(large).count() == 0 and small.count() == large.count()


@pytest.mark.parametrize("build", [marts.vendor_rating, marts.touch_ratio, marts.inventory_turnover],
                         ids=lambda b: b.__name__)
def test_monthly_marts_can_be_built_from_a_month_on(stored, build):
    recent = build(stored, dataclasses.replace(PARAMS, from_month=dt.date(2000, 3, 10)))
    expected = build(stored, PARAMS).where("month >= DATE '2000-03-01'")
    assert recent.exceptAll(expected).count() == 0 and recent.count() == expected.count() > 0
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "p_month" in plan and ">= 200003" in plan


def test_abc_prunes_months_and_columns_and_ranks_inside_ranges(stored):
    plan = marts.moved_quantities(stored, PARAMS)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "quantity_done" in line)
    assert "p_month" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "origin" not in scan and "product_uom_qty" not in scan
    # The running sum is taken inside ranges, so no task ranks a whole company.
    plan = marts.abc_classification(stored, PARAMS)._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan[plan.index("Window ["):].splitlines()[0]


def test_facts_keep_their_number_through_every_lookup(spark):
    given = given_tables(spark, DATA)
    moves = given["stock_move"]
    count = moves.count()
    assert lookups.with_usages(moves, given["stock_location"]).count() == count
    assert lookups.with_template_price(
        lookups.with_product(moves, given["product_product"]), given["product_template"]).count() == count


def test_routes_are_looked_up_once_each_from_sums_written_once(spark, tables, tmp_path):
    some = [move(1), move(2, src=30), move(3, src=None), move(4, dst=None), move(5, company=None), move(6, company=3, src=30, dst=30)]
    t = tables(stock_move=[{**row, "id": 10 * i + row["id"]} for i in range(4) for row in some], **COMMON)
    t["stock_move"].write.parquet(str(tmp_path / "moves"))
    t["stock_location"].write.parquet(str(tmp_path / "places"))
    moves, places = (spark.read.parquet(str(tmp_path / name)) for name in ("moves", "places"))
    small = marts.by_route(moves, places, {"n": F.lit(1)}).groupBy("company_id", "location_id", "location_dest_id", "src_usage", "dst_usage").agg(F.sum("n"))
    large = marts.by_route(moves, places, {"n": F.lit(1)}, broadcast_bytes=0)
    assert not [f for f in large.inputFiles() if "/moves/" in f]
    assert rows_of(large.groupBy("company_id", "location_id", "location_dest_id", "src_usage", "dst_usage").agg(F.sum("n"))) == rows_of(small)
