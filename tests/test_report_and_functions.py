import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaymart.functions import dates, text
from quaymart.plans import report
from quaymart.sources import geo
from quaymart.sources.report_csv import write_reports
from tests.conftest import rows_of

MOVES = ("origin string, company string, warehouse string, kind string, scheduled_date timestamp_ntz, product string, "
         "qty_requested double, qty_done double, source_location_id bigint, dest_location_id bigint")


def out(origin, day, product, qty, kind="OUT", src=1, dst=2):
    return (origin, "c", "w", kind, dt.datetime(2024, 1, day, 9), product, qty, qty, src, dst)


ROWS = [out("d1", 30, "a", 6.0), out("d1", 30, "b", 2.0), out("d2", 31, "a", 3.0), out("d3", 1, "a", 60.0),
        out("d4", 2, "a", 100.0, "IN", 9, 1), out("d5", 3, "b", 5.0, "INT", 1, 3), out("d6", 31, "c", 0.0)]


def test_report_steps(frame):
    moves = frame(MOVES, ROWS)
    daily = report.daily_outbound(moves)
    assert rows_of(daily.where("product = 'a'"), "day", "qty")[0] == (dt.date(2024, 1, 1), 60.0)
    rate = report.avg_outbound(daily, dt.date(2024, 1, 31), days=180, window=30)
    assert rows_of(rate) == [("a", 0.3), ("b", 2 / 30), ("c", 0.0)]
    assert rows_of(report.avg_outbound(daily, dt.date(2024, 1, 31), days=2)) == [("a", 4.5), ("b", 1.0), ("c", 0.0)]
    balance = report.ledger_balance(moves)
    assert balance.agg(F.sum("balance")).collect()[0][0] == 0.0
    assert rows_of(report.ending_stock(balance)) == [("a", 100.0), ("b", 7.0)]
    assert rows_of(report.ending_stock(balance, [1])) == [("a", 31.0)]
    cover = report.days_of_cover(report.ending_stock(balance, [1]), rate)
    assert [(r[0], r[1], round(r[2], 6)) for r in rows_of(cover, "product", "stock", "days_of_cover")] == [
        ("a", 31.0, 103.333333), ("b", 0.0, 0.0)]
    assert rows_of(report.movement_counts(report.picking_headers(moves))) == [("IN", 1), ("INT", 1), ("OUT", 4)]
    summary = rows_of(report.movement_summary(moves, dt.date(2024, 1, 31), 180), "section", "item")
    assert ("top_outbound", "a") in summary and ("lowest_days_of_cover", "b") in summary and len(summary) == 8


def test_merged_summaries_add_full_totals_before_they_cut(frame):
    counts = lambda *r: frame("kind string, pickings bigint", r)
    totals = lambda r: frame("product string, qty double", r)
    first = totals([(f"p{i:02d}", 100.0 - i) for i in range(10)] + [("x", 60.0)])
    second = totals([("x", 60.0), ("p00", 1.0)])
    merged = report.merge_summaries(counts(("OUT", 2)), first, counts(("OUT", 3), ("sale", 1)), second)
    found = rows_of(merged, "section", "item", "amount")
    assert ("top_outbound", "x", 120.0) in found and ("picking_count", "OUT", 5.0) in found
    assert sum(1 for r in found if r[0] == "top_outbound") == 10 and ("top_outbound", "p09", 91.0) not in found


def test_on_hand_by_location(frame):
    quants = frame("location_id bigint, product_id bigint, quantity double", [(1, 1, 2.0), (1, 1, 3.0), (2, 1, None), (1, 2, 1.0)])
    assert rows_of(report.on_hand_by_location(quants)) == [(1, 1, 5.0), (1, 2, 1.0), (2, 1, 0.0)]
    only = report.on_hand_by_location(quants, frame("location_id bigint", [(1,)]), frame("product_id bigint", [(1,)]))
    assert rows_of(only) == [(1, 1, 5.0)]


def test_report_csv_has_a_header(frame, spark, tmp_path):
    pickings, lines = write_reports(frame(MOVES, ROWS).coalesce(1), str(tmp_path), "ke", "d1")
    assert pickings.endswith("pickings_ke_d1") and lines.endswith("moves_ke_d1")
    assert spark.read.option("header", True).csv(lines).count() == len(ROWS)
    assert spark.read.option("header", True).csv(pickings).where("origin = 'd1'").collect()[0]["lines"] == "2"


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4), st.integers(0, 50)), min_size=1, max_size=40))
def test_postings_balance_out(spark, pairs):
    rows = [("d", "c", "w", "INT", dt.datetime(2024, 1, 1), "p", float(q), float(q), s, d) for s, d, q in pairs]
    balance = report.ledger_balance(spark.createDataFrame(rows, MOVES))
    assert (balance.agg(F.sum("balance")).collect()[0][0] or 0.0) == 0.0


def test_text(frame):
    names = [" North-East / Hub ", "a  b\tc", "É1-x", "__A--B__", "O'BRIEN-SMITH KE", "Mixed Case  ok", "123"]
    df = frame("s string", [(n,) for n in names])
    slugs = [r[0] for r in df.select(text.slug(F.col("s"))).collect()]
    assert slugs == ["NORTH_EAST_HUB", "A_B_C", "1_X", "A_B", "OBRIEN_SMITH_KE", "MIXED_CASE_OK", "123"]
    places = [r[0] for r in df.select(text.place_name(F.col("s"))).collect()]
    assert places[4:] == ["O'Brien-Smith Ke", "Mixed Case ok", "123"] and places[0] == "North-East / Hub"


def test_locations_and_documents(frame):
    df = frame("n string, w string", [("KISUMU-GOOD-UNIT-A", "KISUMU"), ("KISUMU-GOOD", "KISUMU"), ("KISUMU-BAD-X", "KISUMU"),
                                      ("OTHER-GOOD-X", "KISUMU"), (None, "KISUMU")])
    parts = df.select(text.location_parts(F.col("n"), F.col("w")).alias("p")).select("p.kind", "p.base").collect()
    assert [tuple(p) for p in parts] == [("GOOD", "UNIT-A")] + [(None, None)] * 4
    key = text.document_key(F.lit("set"), F.lit("ke"), F.lit("W1"), F.lit("OUT"), F.lit(dt.date(2024, 1, 2)), F.col("i"))
    keys = frame("i int", [(7,), (12345,)]).select("i", key.alias("k"))
    assert rows_of(keys, "k") == [("SEED17/set/KE/W1/OUT/2024-01-02/0007",), ("SEED17/set/KE/W1/OUT/2024-01-02/12345",)]
    back = keys.select(text.document_parts(F.col("k")).alias("p")).select("p.dataset", "p.day", "p.seq")
    assert rows_of(back)[0] == ("set", dt.date(2024, 1, 2), 12345)
    assert df.select(text.document_parts(F.col("n")).alias("p")).where("p is not null").count() == 0


def test_stable_numbers(frame):
    values = ["", "product.product:1", "ünï"]
    df = frame("s string", [(v,) for v in values])
    for value, big, small in zip(values, *zip(*df.select(text.stable_int(F.col("s")), text.stable_id(F.col("s"))).collect())):
        number = int(hashlib.sha256(value.encode()).hexdigest()[:16], 16)
        assert int(big) == number and small == number % 900_000_000 + 100_000_000


def test_seasons_weekdays_and_calendar(frame):
    rows = [("rw", "Seeds", dt.date(2024, 2, 9)), ("RW", "Seeds", dt.date(2024, 2, 17)), ("rw", "Seeds", dt.date(2024, 3, 1)),
            ("ke", "Packaging", dt.date(2024, 1, 5))]
    df = frame("c string, k string, d date", rows)
    got = [round(r[0], 6) for r in df.select(dates.seasonal_multiplier(F.col("c"), F.col("k"), F.col("d"))).collect()]
    # 7 of 14 ramp days; full peak; last October plus 75 days of lag leaves 12 of 14 ramp days.
    assert got == [1.0, 2.1, 3.2, round(1 + 0.9 * 12 / 14, 6)]
    week = frame("d date", [(dt.date(2024, 1, n),) for n in range(1, 8)])
    factor = lambda kind: [r[0] for r in week.select(dates.weekday_multiplier(F.lit(kind), F.col("d"))).collect()]
    assert factor("outbound") == [1.0] * 5 + [0.65, 0.15] and factor("internal") == [0.9, 1.2, 1.2, 1.2, 0.9, 0.9, 0.4]
    with pytest.raises(Exception, match="unknown kind"):
        factor("other")
    spans = frame("e date, n int", [(dt.date(2024, 1, 2), 3), (dt.date(2024, 1, 2), 0), (dt.date(2024, 1, 2), -4)])
    assert rows_of(dates.calendar(spans, "e", "n"), "day") == [(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)]
    ends = frame("d date", [(dt.date(2024, 12, 31),), (dt.date(2024, 1, 30),)])
    assert rows_of(ends.select(dates.next_month(F.col("d")))) == [(dt.date(2024, 2, 1),), (dt.date(2025, 1, 1),)]


def test_geography_files(spark, tmp_path):
    (tmp_path / "ke.json").write_text('[{"name": "NAIROBI", "base_units": [" Westlands ", "", "KASARANI"]},\n'
                                      ' {"name": "Uasin  Gishu", "base_units": null}, {"name": "nairobi", "base_units": ["Z"]}]')
    read = geo.read_geo(spark, str(tmp_path / "ke.json"), "KE")
    assert rows_of(read, "country", "wh_pos", "slug", "base_unit", "ord") == [
        ("ke", 0, "NAIROBI", "Z", 0), ("ke", 1, "UASIN_GISHU", None, None)]
    (tmp_path / "rw.json").write_text('{"Gasabo": ["Jali", " Remera"], "Huye": []}')
    assert rows_of(geo.read_geo(spark, str(tmp_path / "rw.json"), "rw"), "warehouse_name", "base_unit", "ord") == [
        ("Gasabo", "Jali", 0), ("Gasabo", "Remera", 1), ("Huye", None, None)]
    (tmp_path / "ug.txt").write_text("# comment\nAbim: [Labwor]\nno colon\n\nAgago: [ Agago West, , Agago North ]\nKumi: []\n")
    text_units = geo.read_geo(spark, str(tmp_path / "ug.txt"), "ug")
    assert rows_of(text_units, "warehouse_name", "base_unit", "ord") == [
        ("Abim", "Labwor", 0), ("Agago", "Agago North", 1), ("Agago", "Agago West", 0), ("Kumi", None, None)]


@pytest.mark.parametrize("name, body", [
    ("a.json", '"text"'), ("b.json", '[{"base_units": []}]'), ("c.json", '{"A": 5}'), ("d.txt", "Abim: Labwor\n")])
def test_wrong_geography_is_an_error(spark, tmp_path, name, body):
    (tmp_path / name).write_text(body)
    with pytest.raises(Exception):
        geo.read_geo(spark, str(tmp_path / name), "ke").collect()
