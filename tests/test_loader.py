import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quaymart.params import MartParams
from quaymart.plans.loading import load_all, load_landed, load_model, lowest_mark, run_log
from quaymart.plans.marts import cost_anomalies
from quaymart.plans.tables import run_sql
from quaymart.schemas import MART_TABLES, RAW_TABLES, enforce_schema
from quaymart.sources.control import read_watermarks, reset_watermarks, save_watermarks
from quaymart.sources.landing import append_table, ensure_tables, merge_table, read_table, refresh_table, write_mart
from quaymart.sources.models import MODELS, landed_lines, read_model
from quaymart.sources.pointer import abandoned
from quaymart.streaming.loader import stream_load
from tests.conftest import rows_of


def move(i, company=2, qty=1.0, date="2024-01-05 00:00:00", written="2024-01-05 00:00:00", **more):
    return {"id": i, "company_id": [company, "Co"] if company else False, "product_id": [7, "P"], "quantity": qty,
            "product_uom_qty": qty, "location_id": [20, "S"], "location_dest_id": [2, "C"], "state": "done",
            "date": date, "date_deadline": False, "origin": False, "write_date": written, "create_date": written, **more}


@pytest.fixture
def land(tmp_path):
    """Write records as one more landed file of a model."""
    def write(model, *records):
        folder = tmp_path / "landing" / model
        folder.mkdir(parents=True, exist_ok=True)
        path = folder / f"part-{len(list(folder.iterdir())):03d}.json"
        path.write_text("".join(json.dumps(r) + "\n" for r in records))
        return str(tmp_path / "landing")
    return write


def load(spark, landing, root, model="stock.move", **options):
    options.setdefault("copy_shared", True)
    stats = load_model(spark, read_model(spark, landing, model), model, root, **options)
    return {r.company_id: (r.rows, r.invalid_rows) for r in stats.collect()}


def test_records_become_rows_of_the_raw_table(spark, land, tmp_path):
    landing = land("stock.move", move(1, origin="PO1"), move(2, company=0), move(3, state="draft"),
                   move(4, product_id=False), move(5, date=False), move(6, company=9))
    root = str(tmp_path / "raw")
    assert load(spark, landing, root, company_ids=[2, 3]) == {2: (2, 2), 3: (1, 0)}
    table = read_table(spark, root, "stock_move")
    assert rows_of(table, "id", "company_id", "origin", "quantity_done", "date_expected", "p_month") == [
        (1, 2, "PO1", 1.0, None, "202401"), (2, 2, "", 1.0, None, "202401"), (2, 3, "", 1.0, None, "202401")]
    assert [f.name for f in table.schema][:-1] == list(RAW_TABLES["stock_move"].columns)


def test_only_newer_records_are_read_and_marks_count_rejected_ones(spark, land, tmp_path):
    root = str(tmp_path / "raw")
    landing = land("stock.move", move(1), move(2, product_id=False, written="2024-01-09 00:00:00"))
    assert load(spark, landing, root, company_ids=[2]) == {2: (1, 1)}
    marks = lambda: rows_of(read_watermarks(spark, f"{root}/_watermarks"))
    assert marks() == [("stock.move", 2, dt.datetime(2024, 1, 9))]
    land("stock.move", move(3, written="2024-01-09 00:00:00"), move(4, product_id=False, written="2024-02-01 00:00:00"))
    # Nothing is inserted: the mark stays although newer rows were seen.
    assert load(spark, landing, root, company_ids=[2]) == {2: (0, 1)}
    assert marks() == [("stock.move", 2, dt.datetime(2024, 1, 9))]
    land("stock.move", move(1, qty=5.0, written="2024-02-02 00:00:00"))
    assert load(spark, landing, root, company_ids=[2]) == {2: (1, 1)}
    assert rows_of(read_table(spark, root, "stock_move"), "id", "quantity_done") == [(1, 5.0)]
    assert marks() == [("stock.move", 2, dt.datetime(2024, 2, 2))]
    state = read_watermarks(spark, f"{root}/_watermarks")
    save_watermarks(reset_watermarks(state), f"{root}/_watermarks")
    assert marks() == [("stock.move", 2, dt.datetime(1970, 1, 1))]


def test_a_row_that_changes_its_month_leaves_the_old_one(spark, land, tmp_path):
    root = str(tmp_path / "raw")
    landing = land("stock.move", move(1), move(2, date="2024-02-05 00:00:00"), move(3, date="2024-02-06 00:00:00"))
    load(spark, landing, root, company_ids=[2])
    land("stock.move", move(1, date="2024-02-07 00:00:00", written="2024-03-01 00:00:00"),
         move(3, date="2024-03-07 00:00:00", written="2024-03-01 00:00:00"))
    load(spark, landing, root, company_ids=[2])
    assert rows_of(read_table(spark, root, "stock_move"), "id", "p_month") == [
        (1, "202402"), (2, "202402"), (3, "202403")]


def test_merging_again_or_an_old_batch_changes_nothing(spark, tmp_path):
    root, name = str(tmp_path / "raw"), "stock_quant"
    def batch(*rows):
        return enforce_schema(spark.createDataFrame(list(rows), "id long, company_id long, product_id long, quantity double, write_date timestamp_ntz"), RAW_TABLES[name])
    old = batch((1, 2, 7, 1.0, dt.datetime(2024, 1, 1)), (2, 2, 7, 1.0, dt.datetime(2024, 1, 1)))
    new = batch((1, 2, 7, 9.0, dt.datetime(2024, 1, 2)))
    for step in (old, new, new, old):
        merge_table(spark, root, name, step)
    assert rows_of(read_table(spark, root, name), "id", "quantity") == [(1, 9.0), (2, 1.0)]
    moved = batch((1, 3, 7, 9.5, dt.datetime(2024, 1, 3)))
    merge_table(spark, root, name, moved, keys=["id"])
    assert rows_of(read_table(spark, root, name), "id", "company_id") == [(1, 3), (2, 2)]
    # A run that was not committed is neither read nor in the way of the next one.
    read_table(spark, root, name).limit(1).write.parquet(f"{root}/{name}/run=r9999999999-stopped")
    assert read_table(spark, root, name).count() == 2
    merge_table(spark, root, name, batch((3, 2, 7, 3.0, dt.datetime(2024, 1, 2))))
    assert rows_of(read_table(spark, root, name), "id") == [(1,), (2,), (3,)]
    folders = sorted(p.name for p in (tmp_path / "raw" / name).iterdir() if p.name.startswith("run="))
    assert [f[:15] for f in folders] == ["run=r0000000005", "run=r0000000006", "run=r9999999999"]
    assert [f.rsplit("/", 1)[1] for f in abandoned(spark, f"{root}/{name}", 1 << 60)] == ["run=r9999999999-stopped"]


def test_full_refresh_restamps_repairs_prices_and_leaves_the_mark(spark, land, frame, tmp_path):
    root = str(tmp_path / "raw")
    record = lambda i, cost, price, company=False: {
        "id": i, "company_id": company, "name": f"T{i}", "standard_price": cost, "list_price": price, "type": "product",
        "write_date": "2024-01-01 00:00:00", "create_date": "2024-01-01 00:00:00"}
    landing = land("product.template", record(1, 5.0, 10.0), record(2, 0.0, 10.0), record(3, 4.0, 10.0, [3, "Three"]))
    props = frame("id bigint, company_id bigint, res_id string, value_float double, name string",
                  [(1, 3, "product.template,1", 8.0, "standard_price"), (2, 3, "product.template,1", 99.0, "weight_factor")])
    products = frame("id bigint, product_tmpl_id bigint", [(1, 1)])
    run = dt.datetime(2024, 5, 1, 6)
    load(spark, landing, root, "product.template", company_ids=[2, 3], refresh_at=run, products=products, properties=props)
    table = read_table(spark, root, "product_template")
    assert rows_of(table, "id", "company_id", "standard_price") == [(1, 2, 5.0), (1, 3, 8.0), (2, 2, 7.0), (2, 3, 7.0), (3, 3, 4.0)]
    assert table.where(F.col("write_date") != F.lit(run).cast("timestamp_ntz")).count() == 0
    assert read_watermarks(spark, f"{root}/_watermarks").count() == 0


def test_companies_are_loaded_once_without_a_company(spark, land, tmp_path):
    landing = land("res.company", {"id": 1, "name": "One", "write_date": "2024-01-01 00:00:00"},
                   {"id": 2, "name": False, "write_date": "2024-01-01 00:00:00"})
    root = str(tmp_path / "raw")
    assert load(spark, landing, root, "res.company", company_ids=[1, 2]) == {0: (1, 1)}
    assert rows_of(read_table(spark, root, "res_company"), "id", "name") == [(1, "One")]


def test_a_stream_of_files_gives_the_table_of_one_load(spark, land, tmp_path):
    batches = [[move(1), move(2, company=0)], [move(1, qty=4.0, written="2024-01-06 00:00:00"), move(3, state="draft")],
               [move(1, qty=2.0, written="2024-01-02 00:00:00"), move(4, origin="PO4")]]
    for batch in batches:
        landing = land("stock.move", *batch)
    load(spark, landing, str(tmp_path / "once"), company_ids=[2, 3])
    def stream():
        stream_load(spark, landing, "stock.move", str(tmp_path / "streamed"), str(tmp_path / "checkpoint"),
                    company_ids=[2, 3], copy_shared=True, files_per_batch=1).awaitTermination()
    stream()
    once, streamed = (read_table(spark, str(tmp_path / name), "stock_move") for name in ("once", "streamed"))
    assert rows_of(streamed) == rows_of(once) and once.count() == 4
    land("stock.move", move(5))
    stream()
    assert read_table(spark, str(tmp_path / "streamed"), "stock_move").count() == 5


def test_every_model_has_its_columns():
    for spec in MODELS.values():
        columns = [spec.aliases.get(name, name) for name in spec.fields]
        assert set(columns) == set(spec.raw.columns), spec.model
        assert set(spec.required) <= set(columns)


def test_marts_are_replaced_by_day_and_by_month(spark, frame, tmp_path):
    root = str(tmp_path)
    def snapshot(day, cost):
        return frame("snapshot_date date, company_id bigint, product_id bigint, unit_cost double", [(day, 1, 1, cost)])
    first, second = dt.date(2024, 5, 1), dt.date(2024, 5, 2)
    for day, cost in ((first, 1.0), (second, 2.0), (first, 3.0), (first, 3.0)):
        assert write_mart(snapshot(day, cost), root, "cost_anomalies", day) == 1
    assert rows_of(read_table(spark, root, "cost_anomalies"), "snapshot_date", "unit_cost") == [(first, 3.0), (second, 2.0)]
    assert write_mart(snapshot(first, 0.0).limit(0), root, "cost_anomalies", first) == 0
    assert rows_of(read_table(spark, root, "cost_anomalies"), "snapshot_date") == [(second,)]
    months = frame("month date, company_id bigint, partner_id bigint, overall_score double", [(first, 1, 1, 0.5), (dt.date(2024, 6, 1), 1, 1, 0.6)])
    for _ in range(2):
        write_mart(months, root, "vendor_rating")
    write_mart(months.where("overall_score > 0.5").withColumn("overall_score", F.lit(0.9)), root, "vendor_rating")
    assert rows_of(read_table(spark, root, "vendor_rating"), "overall_score") == [(0.5,), (0.9,)]


def test_tables_can_be_created_and_appended_to(spark, frame, tmp_path):
    root = str(tmp_path)
    names = ensure_tables(spark, root)
    assert len(names) == len(RAW_TABLES) + len(MART_TABLES) and ensure_tables(spark, root) == names
    companies = frame("name string, id bigint, extra int", [("One", 1, 0), ("Two", 2, 0)])
    assert append_table(companies, root, "res_company") == 2
    refresh_table(spark, root, "res_company")
    assert rows_of(spark.table("raw_res_company"), "id", "name") == [(1, "One"), (2, "Two")]
    merge_table(spark, root, "res_company", frame("name string, id bigint", [("Three", 3), ("Uno", 1)]))
    refresh_table(spark, root, "res_company")
    assert rows_of(spark.table("raw_res_company"), "id") == [(1,), (2,), (3,)]
    rating = "month date, company_id bigint, partner_id bigint, overall_score double"
    rows = [(dt.date(2024, m, 1), 1, 1, 0.5) for m in (1, 2, 3)]
    write_mart(frame(rating, rows), root, "vendor_rating")
    refresh_table(spark, root, "vendor_rating")
    assert spark.table("mart_vendor_rating").count() == 3
    # A complete rebuild from February on in which March has no rows any more.
    write_mart(frame(rating, rows[1:2]), root, "vendor_rating", complete_from=dt.date(2024, 2, 1))
    refresh_table(spark, root, "vendor_rating")
    assert rows_of(spark.table("mart_vendor_rating"), "p_month") == [("202401",), ("202402",)]
    assert cost_anomalies({name: read_table(spark, root, name) for name in RAW_TABLES}, MartParams(dt.date(2024, 1, 1))).count() == 0
    named = run_sql(spark, "SELECT id FROM {c} WHERE id > :dead_stock_days", MartParams(dt.date(2024, 1, 1), (), 1),
                    c=read_table(spark, root, "res_company"))
    assert rows_of(named) == [(2,), (3,)]
    for name in names:
        spark.sql(f"DROP VIEW {name}")


def test_forecasts_are_merged_by_product_and_month(frame, spark, tmp_path):
    ddl = "forecast_month date, company_id bigint, product_id bigint, forecast_qty double"
    march, april = dt.date(2024, 3, 1), dt.date(2024, 4, 1)
    write_mart(frame(ddl, [(march, 1, 1, 5.0), (march, 1, 2, 6.0)]), str(tmp_path), "demand_forecast")
    write_mart(frame(ddl, [(april, 1, 1, 7.0), (march, 1, 2, 8.0)]), str(tmp_path), "demand_forecast")
    assert rows_of(read_table(spark, str(tmp_path), "demand_forecast"), "forecast_month", "product_id", "forecast_qty") == [
        (march, 1, 5.0), (march, 2, 8.0), (april, 1, 7.0)]


def test_lines_that_are_no_json_are_kept_and_counted(spark, land, tmp_path):
    root = str(tmp_path / "raw")
    landing = land("stock.move", move(1))
    (tmp_path / "landing" / "stock.move" / "broken.json").write_text('{"id": 2, "company\n\n')
    stats = load_landed(spark, landing, "stock.move", root, company_ids=[2])
    assert rows_of(stats, "company_id", "rows", "invalid_rows") == [(None, 0, 1), (2, 1, 0)]
    assert spark.read.parquet(f"{root}/_malformed/stock_move").first()[0] == '{"id": 2, "company'
    assert spark.read.parquet(run_log(root)).count() == 2


def test_broken_lines_of_later_loads_are_kept_once(spark, land, tmp_path):
    root, folder = str(tmp_path / "raw"), tmp_path / "landing" / "stock.move"
    landing = land("stock.move", move(1), move(2, company_id=False))
    load = lambda **more: rows_of(load_landed(
        spark, landing, "stock.move", root, company_ids=[2], **more).where("company_id IS NULL"), "invalid_rows")
    kept = lambda: rows_of(spark.read.parquet(f"{root}/_malformed/stock_move"), "value")
    (folder / "broken.json").write_text("{a\n")
    assert load() == [(1,)]
    assert lowest_mark(read_watermarks(spark, f"{root}/_watermarks"), "stock.move", [2]) is not None
    (folder / "later.json").write_text("{b\n{a\n{b\n")
    assert load() == [(3,)] and kept() == [("{a",), ("{a",), ("{b",), ("{b",)]
    assert load() == [] and load(refresh_at=dt.datetime(2024, 5, 1)) == [] and len(kept()) == 4
    (folder / "later.json").write_text("{b\n{a\n{b\n{b\n")
    assert load() == [(1,)] and len(kept()) == 5
    assert rows_of(spark.read.parquet(run_log(root)).where("company_id IS NULL"), "invalid_rows") == [(1,), (1,), (3,)]


def test_the_lowest_mark_reaches_the_source(spark, frame, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "raw")
    typed = "id bigint, company_id bigint, name string, usage string, write_date timestamp_ntz, create_date timestamp_ntz"
    day = lambda d: dt.datetime(2024, 1, d)
    rows = lambda *given: frame(typed, [(i, c, f"L{i}", "internal", day(d), day(1)) for i, c, d in given])
    target = f"{landing}/stock.location"
    rows((1, 2, 3), (2, 3, 5), (3, 0, 4)).write.parquet(target)
    load = lambda: load_landed(spark, landing, "stock.location", root, company_ids=[2, 3], fmt="parquet")
    assert rows_of(load(), "company_id", "rows") == [(0, 1), (2, 1), (3, 1)]
    state = read_watermarks(spark, f"{root}/_watermarks")
    bound = lowest_mark(state, "stock.location", [2, 3])
    assert bound == day(3) and lowest_mark(state, "stock.location", [2, 3, 4]) is None
    plan = read_model(spark, landing, "stock.location", fmt="parquet", newer_than=bound)
    assert "GreaterThan(write_date,2024-01-03T00:00" in plan._jdf.queryExecution().executedPlan().toString()
    rows((1, 2, 9), (2, 3, 2), (4, 0, 9)).write.mode("append").parquet(target)
    assert rows_of(load(), "company_id", "rows") == [(0, 1), (2, 1)]
    assert rows_of(read_table(spark, root, "stock_location"), "id", "write_date") == [
        (1, day(9)), (2, day(5)), (3, day(4)), (4, day(9))]
    load_all(spark, landing, root, company_ids=[2, 3], refresh=frozenset({"stock.location"}), run_at=day(20), fmt="parquet")
    assert {r[0] for r in read_table(spark, root, "stock_location").select("write_date").collect()} == {day(20)}


def test_a_landed_line_is_parsed_once(spark, tmp_path):
    path = tmp_path / "lines.json"
    path.write_text('{"id": 1}\n\n   \n{"id": \n')
    lines = landed_lines(spark, [str(path)], "stock.move")
    plan = lines._jdf.queryExecution().optimizedPlan().toString().lower().replace("_", "")
    assert plan.count("parsejson") == 1
    assert rows_of(lines, "id", "broken") == [(None, '{"id": '), (1, None)]
