"""Loads of new files, commits, the key index, names, kept days, and joins and sums that spread hot keys."""

import datetime as dt
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks import stored
from quaymart.operators import ranking, scopes, sizing, thinning
from quaymart.operators.versions import latest
from quaymart.params import MartParams
from quaymart.plans import loading, marts, movement_days
from quaymart.plans.tables import Tables
from quaymart.schemas import RAW_TABLES, with_month
from quaymart.sources import landing, pointer
from quaymart.sources.report_csv import write_all_reports
from tests.conftest import rows_of
from tests.test_loader import land, move  # noqa: F401

MOVE = "id bigint, company_id bigint, product_id bigint, quantity_done double, date_done timestamp_ntz, write_date timestamp_ntz"


def at(month, day=1):
    return dt.datetime(2024, month, day)


def load(spark, folder, root, companies=(2,), **more):
    stats = loading.load_landed(spark, folder, "stock.move", root, company_ids=list(companies), **more)
    return sum(r["rows"] for r in stats.collect())


def test_files_taken_before_are_not_opened(spark, land, tmp_path):  # noqa: F811
    root, folder = str(tmp_path / "raw"), land("stock.move", move(1, qty=1.0), move(2, company=3))
    assert load(spark, folder, root) == 1
    first = tmp_path / "landing" / "stock.move" / "part-000.json"
    time, text = os.stat(first).st_mtime_ns, first.read_text()
    later = text.replace("2024-01-05", "2024-09-05").replace('"id": 1,', '"id": 7,')
    assert len(later) == len(text)
    first.write_text(later)  # the same length and time: nobody should look inside
    os.utime(first, ns=(time, time))
    land("stock.move", move(4, written="2024-02-01 00:00:00"))
    assert load(spark, folder, root) == 1 and load(spark, folder, root) == 0
    assert rows_of(landing.read_table(spark, root, "stock_move"), "id") == [(1,), (4,)]
    # A company that was not asked for before finds its records in old files.
    assert load(spark, folder, root, (2, 3)) == 2
    assert rows_of(landing.read_table(spark, root, "stock_move"), "id", "company_id") == [(1, 2), (2, 3), (4, 2), (7, 2)]
    os.utime(first, ns=(time + 10**9, time + 10**9))  # changed: read again
    first.write_text(later.replace("2024-09-05", "2024-10-05"))
    assert load(spark, folder, root, (2, 3)) == 2
    assert load(spark, folder, root, (2, 3), refresh_at=dt.datetime(2024, 12, 1)) == 3


def test_typed_files_are_taken_once(spark, frame, tmp_path):
    target, root = str(tmp_path / "landing" / "res.company"), str(tmp_path / "raw")
    ddl = "id bigint, name string, write_date timestamp_ntz, create_date timestamp_ntz"
    frame(ddl, [(1, "One", at(1), at(1))]).coalesce(1).write.parquet(target)
    run = lambda: [r["rows"] for r in loading.load_landed(
        spark, str(tmp_path / "landing"), "res.company", root, company_ids=[1], fmt="parquet").collect()]
    assert run() == [1] and run() == []
    for name in os.listdir(target):
        if name.startswith("part"):
            size, time = os.stat(f"{target}/{name}").st_size, os.stat(f"{target}/{name}").st_mtime_ns
            with open(f"{target}/{name}", "wb") as file:
                file.write(b"x" * size)
            os.utime(f"{target}/{name}", ns=(time, time))
    frame(ddl, [(2, "Two", at(2), at(1))]).coalesce(1).write.mode("append").parquet(target)
    assert run() == [1]


def moves(spark, rows):
    return spark.createDataFrame(rows, MOVE)


def test_merges_leave_other_months_alone(spark, tmp_path):
    root, path = str(tmp_path), str(tmp_path / "stock_move")
    landing.merge_table(spark, root, "stock_move", moves(spark, [
        (i, 2, 7, float(i), at(month, 5), at(month)) for month in range(1, 7) for i in (month, 10 + month)]))
    before = pointer.current(spark, path)
    for part, runs in before.parts.items():  # what is not touched may be unreadable
        if part not in ("p_month=202402", "p_month=202405"):
            folder = f"{path}/run={runs[0]}/{part}"
            for name in os.listdir(folder):
                with open(f"{folder}/{name}", "wb") as file:
                    file.write(b"no table")
    landing.merge_table(spark, root, "stock_move", moves(spark, [(2, 2, 7, 99.0, at(5, 6), at(9))]))
    after = pointer.current(spark, path)
    assert {p for p in after.parts if after.parts[p] != before.parts[p]} == {"p_month=202402", "p_month=202405"}
    touched = landing.read_months(spark, root, "stock_move", after, ["202402", "202405"])
    assert rows_of(touched, "id", "quantity_done", "p_month") == [
        (12, 12.0, "202402"), (15, 15.0, "202405"), (2, 99.0, "202405"), (5, 5.0, "202405")]


@pytest.mark.parametrize("keys", [None, ["id"]])
def test_many_merges_give_the_newest_versions(spark, tmp_path, monkeypatch, keys):
    monkeypatch.setattr(landing, "KEY_RUNS", 2)
    monkeypatch.setattr(landing, "KEY_BUCKETS", 3)
    draw, root, every = random.Random(str(keys)), str(tmp_path), []
    spec = RAW_TABLES["stock_move"]
    for step in range(7):
        rows = [(draw.randint(1, 12), draw.choice([2, 3]) if keys else 2, 7, draw.random(),
                 draw.choice([at(draw.randint(1, 4), 3), None]), at(draw.randint(1, 12), step + 1)) for _ in range(5)]
        batch = latest(moves(spark, rows), keys or ["id", "company_id"], "write_date")
        rows = [tuple(r) for r in batch.select(*MOVE.replace(" bigint", "").replace(" double", "").replace(" timestamp_ntz", "").split(", ")).collect()]
        if step == 1:  # rows that an append doubles are found and reduced later
            landing.append_table(moves(spark, rows), root, "stock_move")
        else:
            landing.merge_table(spark, root, "stock_move", moves(spark, rows), keys)
        every += rows
    landing.merge_table(spark, root, "stock_move", moves(spark, every), keys)
    want = with_month(latest(landing.enforce_schema(moves(spark, every), spec), keys or spec.keys, spec.version), spec)
    assert rows_of(landing.read_table(spark, root, "stock_move")) == rows_of(want.select(*spec.columns, "p_month"))
    assert all(len(runs) <= 3 for runs in pointer.current(spark, f"{root}/stock_move").keys.values())


def test_a_run_that_stops_before_the_commit_changes_nothing(spark, frame, tmp_path, monkeypatch):
    root, ddl = str(tmp_path), "month date, company_id bigint, partner_id bigint, overall_score double"
    rows = [(dt.date(2024, m, 1), 1, 1, 0.5) for m in (1, 2, 3)]
    landing.write_mart(frame(ddl, rows), root, "vendor_rating")
    read = lambda: rows_of(landing.read_table(spark, root, "vendor_rating"), "p_month", "overall_score")
    old = read()
    again = frame(ddl, [(dt.date(2024, 2, 1), 1, 1, 0.9)])

    def stop(*_args):
        raise RuntimeError("stopped")
    with monkeypatch.context() as patch:
        patch.setattr(landing, "commit", stop)
        with pytest.raises(RuntimeError):
            landing.write_mart(again, root, "vendor_rating", complete_from=dt.date(2024, 2, 1))
    assert read() == old and len(pointer.abandoned(spark, f"{root}/vendor_rating", 1 << 60)) == 1
    before = landing.read_table(spark, root, "vendor_rating")
    landing.write_mart(again, root, "vendor_rating", complete_from=dt.date(2024, 2, 1))
    assert read() == [("202401", 0.5), ("202402", 0.9)]
    assert before.count() == 3  # a reader that began before the write keeps its files
    stale = pointer.Pointer(1)
    with pytest.raises(pointer.ConcurrentWrite):
        pointer.commit(spark, f"{root}/vendor_rating", stale, {}, {})
    assert read() == [("202401", 0.5), ("202402", 0.9)]


def test_names_follow_every_write(spark, frame, tmp_path):
    root, other = str(tmp_path / "a"), str(tmp_path / "b")
    names = landing.ensure_tables(spark, root)
    try:
        assert spark.table("raw_stock_move").count() == 0 and spark.table("raw_stock_move").columns[-1] == "p_month"
        landing.merge_table(spark, root, "stock_move", moves(spark, [(1, 2, 7, 1.0, at(1), at(1)), (2, 2, 7, 2.0, None, at(1))]))
        landing.merge_table(spark, root, "stock_move", moves(spark, [(1, 2, 7, 5.0, at(2), at(2))]))
        landing.append_table(frame("id bigint, name string", [(1, "One")]), root, "res_company")
        landing.append_table(frame("id bigint, name string", [(9, "Elsewhere")]), other, "res_company")
        assert rows_of(spark.table("raw_stock_move"), "id", "quantity_done", "p_month") == [(1, 5.0, "202402"), (2, 2.0, None)]
        assert rows_of(spark.table("raw_res_company"), "id", "name") == [(1, "One")]
        day = dt.date(2024, 5, 1)
        cost = frame("snapshot_date date, company_id bigint, product_id bigint, unit_cost double", [(day, 1, 1, 2.0)])
        landing.write_mart(cost, root, "cost_anomalies", day)
        assert rows_of(spark.table("mart_cost_anomalies"), "snapshot_date", "unit_cost", "p_month") == [(day, 2.0, "202405")]
        assert [tuple(f) for f in spark.table("raw_stock_move").dtypes][:2] == [("id", "bigint"), ("company_id", "bigint")]
        plan = spark.table("raw_stock_move").where("p_month = '202402'")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan
    finally:
        for name in names:
            spark.sql(f"DROP VIEW {name}")


def test_kept_days_follow_corrections(spark, tmp_path):
    root = str(tmp_path)
    ddl = "id bigint, company_id bigint, product_id bigint, state string, date_done timestamp_ntz, write_date timestamp_ntz"
    def merge(*rows):
        landing.merge_table(spark, root, "stock_move_line", spark.createDataFrame(list(rows), ddl))
    merge((1, 2, 7, "done", at(1, 5), at(1)), (2, 2, 7, "done", at(3, 5), at(1)), (3, 2, 8, "done", at(2, 9), at(1)),
          (4, 3, 8, "draft", at(3, 9), at(1)))
    assert not movement_days.is_fresh(spark, root) and "movement_days" not in Tables.from_root(spark, root)
    assert len(movement_days.refresh(spark, root)) == 3 and movement_days.refresh(spark, root) == []
    def days(as_of=dt.date(2024, 4, 15), fresh=True):
        t = Tables.from_root(spark, root)
        assert ("movement_days" in t) == fresh
        plain = Tables.of(stock_move_line=landing.read_table(spark, root, "stock_move_line"))
        found = rows_of(marts.last_movements(t, MartParams(as_of)), "company_id", "product_id", "last_movement_date")
        assert found == rows_of(marts.last_movements(plain, MartParams(as_of)), "company_id", "product_id", "last_movement_date")
        return found
    assert days() == [(2, 7, dt.date(2024, 3, 5)), (2, 8, dt.date(2024, 2, 9))]
    assert days(dt.date(2024, 3, 4)) == [(2, 7, dt.date(2024, 1, 5)), (2, 8, dt.date(2024, 2, 9))]
    merge((2, 2, 7, "done", at(1, 2), at(2)), (3, 2, 8, "cancel", at(2, 9), at(2)))  # a date goes down, a move is called off
    days(fresh=False)
    assert movement_days.refresh(spark, root) == ["p_month=202401", "p_month=202402", "p_month=202403"]
    assert days() == [(2, 7, dt.date(2024, 1, 5))]


# --- windows, sums and hot keys ---------------------------------------------------------------------


def test_windows_become_disjoint_segments(spark):
    draw, start = random.Random(2), dt.date(2015, 1, 1)
    day = lambda n: start + dt.timedelta(days=n)
    windows = [(draw.choice(["STOCKOUT", "SUPPLIER_DELAY", "SHRINKAGE", "OTHER"]), draw.choice("abc"), day(n := draw.randint(0, 900)),
                draw.choice([None, day(n + draw.randint(-2, 200))])) for _ in range(60)]
    windows += [("SUPPLIER_DELAY", "d", day(0), day(3650)), ("STOCKOUT", None, day(1), day(2)), ("STOCKOUT", "a", None, day(5))]
    frame = spark.createDataFrame(windows, "kind string, company string, date date, end_date date")
    segments = scopes.window_segments(frame).where("company IS NOT NULL")
    assert segments.count() <= 2 * len(windows) and segments.where("company = 'd'").count() == 1
    rows = [(c, day(n), f"{c}{n}", n) for c in "abcd" for n in range(0, 1200, 7)] + [(None, day(1), "x", 0), ("a", None, "y", 0)]
    found = scopes.tag_windows(spark.createDataFrame(rows, "company string, date date, note string, last int"), frame)

    def open_on(company, date, kind):
        return company is not None and date is not None and any(
            k == kind and c == company and d is not None and (d == date if kind == "SHRINKAGE" else e is not None and d <= date <= e)
            for k, c, d, e in windows)
    assert rows_of(found) == sorted(
        ((*r, open_on(r[0], r[1], "STOCKOUT"), 15 * open_on(r[0], r[1], "SUPPLIER_DELAY"), open_on(r[0], r[1], "SHRINKAGE"))
         for r in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_a_run_of_equal_values_is_spread(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(ranking, "durable", lambda df: kept.append(sizing.durable(df)) or kept[-1])
    df = spark.range(1_000_000).select(F.lit(1).alias("g"), "id", F.lit(0).cast("decimal(28,4)").alias("v"))
    found = ranking.running_totals(df.withColumn("v", F.col("v") + 1), "g", "v", ["id"], ranges=20)
    assert found.where("running <> id + 1 OR total <> 1000000").count() == 0
    sizes = [r["count"] for r in kept[0].groupBy("_range").count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 120_000


def test_only_hot_keys_are_salted_and_by_their_size(spark, tmp_path):
    fact = spark.range(40_000).select(
        "id", F.when(F.col("id") % 10 < 5, 3).when(F.col("id") % 10 == 9, F.lit(None)).otherwise(F.col("id")).alias("k"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = sizing.heavy_hitters(fact, ["k"])
    assert sorted(heavy.values())[-1] in (parts // 2, parts // 2 + 1) and len(heavy) <= parts
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        heavy = sizing.heavy_hitters(fact, ["k"])
        assert sorted(heavy.values()) in ([2, 8], [2, 9])  # a key with half of the rows, and the rows without one
        dim = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        joined = sizing.lookup_join(fact, dim, ["k"], salt_by="id", broadcast_bytes=-1)
        assert joined.columns == ["k", "id", "v"] or set(joined.columns) == {"id", "k", "v"}
        assert joined.count() == 40_000 and joined.where("v IS NOT NULL AND v <> 2 * k").count() == 0
        assert joined.where("k = 3 AND v = 6").count() == 20_000 and joined.where("k >= 2000 AND v IS NOT NULL").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    assert sizing.heavy_hitters(fact.limit(0), ["k"]) == {}


def test_reports_of_all_countries_are_replaced_one_by_one(spark, tmp_path):
    ddl = "country string, dataset string, origin string, kind string, qty_done double"
    rows = [("ke", "d/1", "a", "OUT", 1.0), ("ke", "d/1", "a", "OUT", 2.0), ("rw", "d=2", "b", "IN", 3.0), ("rw", "x y", "c", "IN", 4.0)]
    write_all_reports(spark.createDataFrame(rows, ddl), str(tmp_path))
    pickings, lines = write_all_reports(spark.createDataFrame([("rw", "x y", "c", "IN", 9.0)], ddl), str(tmp_path))
    read = lambda path: spark.read.option("header", True).csv(path)
    assert rows_of(read(lines), "country", "dataset", "qty_done") == [
        ("ke", "d/1", "1.0"), ("ke", "d/1", "2.0"), ("rw", "d=2", "3.0"), ("rw", "x y", "9.0")]
    assert Counter(r["lines"] for r in read(pickings).collect()) == {"2": 1, "1": 2}
    assert json.dumps(sorted(os.listdir(lines))[-2:]) == '["country=ke", "country=rw"]'


def test_corrections_are_landed_by_as_many_tasks_as_read_them(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "folder", lambda spark, name: str(tmp_path / name))
    lines = spark.range(0, 4000, 1, 8).select(
        "id", F.array(F.lit("2"), F.lit("C")).alias("company_id"), F.array(F.lit("5"), F.lit("P")).alias("product_id"),
        F.lit(1.0).alias("quantity"), F.array(F.lit("8"), F.lit("S")).alias("location_id"), F.lit("done").alias("state"),
        F.lit("1995-03-01 00:00:00").alias("date"), F.lit("1995-03-01 00:00:00").alias("write_date"))
    t = {"region": spark.range(1), "orders": spark.range(200).select(F.col("id").alias("o_orderkey"))}
    root = stored.load_twice(t, lambda _: lines)
    landed = spark.read.text(str(tmp_path / "landing" / stored.LINES)).select("value", F.col("_metadata.file_path").alias("file"))
    assert landed.where(F.col("value").contains(stored.CORRECTED_AT)).select("file").distinct().count() == 8
    assert landing.read_table(spark, root, "stock_move_line").where("qty_done = 2").count() == 399  # an id of 0 is none


def test_a_first_merge_writes_no_copy_of_its_batch(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(landing, "durable", lambda df: written.append(df) or sizing.durable(df))
    rows = spark.createDataFrame([(1, 2, 3, 1.0, at(1), at(1)), (1, 2, 3, 2.0, at(2), at(2)), (2, 2, 3, 1.0, None, at(1))], MOVE)
    root = str(tmp_path / "raw")
    landing.merge_table(spark, root, "stock_move", rows)
    assert not written
    later = rows.where("id = 1").withColumns({"quantity_done": F.lit(3.0), "date_done": F.lit(at(5)), "write_date": F.lit(at(5))})
    landing.merge_table(spark, root, "stock_move", later)
    assert len(written) == 1
    assert rows_of(landing.read_table(spark, root, "stock_move"), "id", "quantity_done", "p_month") == [
        (1, 3.0, "202405"), (2, 1.0, None)]


def test_a_merge_shuffles_what_it_changes_and_writes_nothing_for_nothing(spark, tmp_path, monkeypatch):
    root, path, staged, stage = str(tmp_path), str(tmp_path / "stock_move"), [], landing._stage

    def noted(df, *args, **more):
        staged.append(df.count())
        return stage(df, *args, **more)
    rows = [(i, 2, 7, 1.0, at(1 + i % 4, 5), at(1)) for i in range(800)]
    landing.merge_table(spark, root, "stock_move", moves(spark, rows))
    monkeypatch.setattr(landing, "_stage", noted)
    newer = moves(spark, [(i, 2, 7, 2.0, at(5), at(2)) for i in range(0, 800, 200)] + [(900, 2, 7, 2.0, at(2), at(2))])
    landing.merge_table(spark, root, "stock_move", newer)
    after = pointer.current(spark, path)
    assert sum(staged) < 20 and sorted(after.parts) == [f"p_month=20240{m}" for m in range(1, 6)]
    assert after.parts["p_month=202403"] == after.parts["p_month=202404"] != after.parts["p_month=202401"]  # those lost no row
    older = moves(spark, [(i, 2, 7, -1.0, at(6), dt.datetime(2023, 1, 1)) for i in range(50)])
    assert [landing.merge_table(spark, root, "stock_move", b) for b in (newer, older, newer)] == [0, 0, 0]
    assert len(staged) == 1 and pointer.current(spark, path) == after
    want = {r[0]: (r[3], r[4]) for r in rows} | {i: (2.0, at(5)) for i in range(0, 800, 200)} | {900: (2.0, at(2))}
    assert rows_of(landing.read_table(spark, root, "stock_move"), "id", "quantity_done", "date_done") == sorted(
        ((i, *v) for i, v in want.items()), key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("broadcast", [sizing.BROADCAST_BYTES, -1])
def test_merges_of_distinct_rows_with_null_keys(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(thinning, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(landing, "KEY_RUNS", 2)
    monkeypatch.setattr(landing, "SMALL_FILES", 2)
    draw, root, every, spec = random.Random(5), str(tmp_path), [], RAW_TABLES["stock_move"]
    for step in range(4):
        rows = [(draw.randint(1, 40), draw.choice([2, 3, None]), draw.choice([7, None]), float(draw.randint(0, 3)),
                 draw.choice([at(draw.randint(1, 5), 3), None]), draw.choice([at(draw.randint(1, 12)), None])) for _ in range(60 - 12 * step)]
        landing.merge_table(spark, root, "stock_move", moves(spark, rows + rows[:3]))
        every += rows
        assert pointer.current(spark, f"{root}/stock_move").distinct
        want = with_month(latest(landing.enforce_schema(moves(spark, every), spec), spec.keys, spec.version), spec)
        assert rows_of(landing.read_table(spark, root, "stock_move")) == rows_of(want.select(*spec.columns, "p_month"))
    landing.append_table(moves(spark, every[:9]), root, "stock_move")
    assert not pointer.current(spark, f"{root}/stock_move").distinct
    landing.merge_table(spark, root, "stock_move", moves(spark, every))
    assert rows_of(landing.read_table(spark, root, "stock_move")) == rows_of(want.select(*spec.columns, "p_month"))


def test_no_wanted_row_is_thinned_out(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("a"), (F.col("id") % 3).alias("b"))
    wanted = rows.where("a % 100 = 7 OR a IS NULL AND b = 1")
    found = thinning.told(rows, ["a", "b"], wanted).select("*", F.expr("a % 100 = 7 OR a IS NULL AND b = 1").alias("want"))
    assert found.where("want AND NOT _perhaps").count() == 0 and found.where("_perhaps AND NOT coalesce(want, false)").count() < 20
    assert found.count() == 20_000


def test_a_write_frees_its_shuffles_and_leaves_the_settings(spark, frame, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name), spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sizing.shuffles_freed(spark, 1 << 20):
        assert spark.conf.get(name) == "true" and int(spark.conf.get("spark.sql.files.maxPartitionBytes")) == 1 << 20
    assert (spark.conf.get(name), spark.conf.get("spark.sql.files.maxPartitionBytes")) == before
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    held = tracker.shuffleStatuses().size()
    assert sizing.durable(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    assert tracker.shuffleStatuses().size() <= held + 1  # that of the count
