import datetime as dt

from pyspark.sql import functions as F

from quaymart.operators import lookups
from quaymart.operators.sizing import lookup_join, scan_bytes
from quaymart.operators.versions import latest, merge_batch
from tests.conftest import rows_of

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
VERSIONED = "company_id bigint, id bigint, write_date timestamp_ntz, qty double"


def test_latest_takes_the_newest_and_breaks_ties_by_the_other_columns(frame):
    df = frame(VERSIONED, [(1, 1, T1, 9.0), (1, 1, T2, 1.0), (1, 1, T2, 2.0), (2, 1, T1, 5.0), (2, 2, None, 7.0)])
    assert rows_of(latest(df, ["company_id", "id"], "write_date"), "company_id", "id", "qty") == [
        (1, 1, 2.0), (2, 1, 5.0), (2, 2, 7.0)]


def test_latest_limits_a_hot_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("id"), F.col("id").alias("write_date"))
    plan = latest(df, ["id"], "write_date")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_batches_in_any_order_and_twice_give_the_same_table(frame):
    first = frame(VERSIONED, [(1, 1, T1, 1.0), (1, 2, T1, 1.0)])
    second = frame(VERSIONED, [(1, 1, T2, 2.0), (1, 3, T1, 3.0)])
    keys = ["company_id", "id"]
    expected = [(1, 1, 2.0), (1, 2, 1.0), (1, 3, 3.0)]
    for order in ((first, second), (second, first), (first, second, first, second)):
        table = order[0]
        for batch in order[1:]:
            table = merge_batch(table, batch, keys, "write_date")
        assert rows_of(table, "company_id", "id", "qty") == expected


PRODUCTS = "id bigint, company_id bigint, product_tmpl_id bigint, default_code string"
PRODUCT_ROWS = [
    (1, 0, 10, "SHARED"), (1, 2, 11, "OWN2"), (1, 3, 12, "OWN3"),
    (2, 0, 20, ""), (2, 4, 21, "FOUR"), (2, 5, 22, "FIVE"),
    (3, 5, 30, "X5"), (3, 4, 31, "X4"),
    (4, 0, 40, ""),
]


def test_own_company_beats_shared_beats_any_and_blank_codes_are_missing(frame):
    facts = frame("company_id bigint, product_id bigint, n int",
                  [(2, 1, 1), (9, 1, 2), (2, 2, 3), (4, 2, 4), (1, 3, 5), (5, 3, 6), (1, 4, 7), (1, 99, 8)])
    for limit in (2**62, 0):  # broadcast, then shuffle
        found = lookups.with_product(facts, frame(PRODUCTS, PRODUCT_ROWS), broadcast_bytes=limit)
        assert rows_of(found, "n", "product_default_code", "product_tmpl_id") == [
            (1, "OWN2", 11), (2, "SHARED", 10), (3, "FOUR", 20), (4, "FOUR", 21), (5, "X4", 31), (6, "X5", 30),
            (7, "", 40), (8, "", None)]


def test_a_product_with_two_templates_is_still_one_row(frame):
    products = frame(PRODUCTS + ", write_date timestamp_ntz",
                     [(1, 2, 10, "OLD", T1), (1, 2, 11, "NEW", T2), (1, 0, 12, "S", T1)])
    facts = frame("company_id bigint, product_id bigint", [(2, 1), (2, 1), (3, 1)])
    assert rows_of(lookups.with_product(facts, products), "company_id", "product_default_code") == [
        (2, "NEW"), (2, "NEW"), (3, "S")]


LOCATIONS = "id bigint, company_id bigint, name string, usage string"
LOCATION_ROWS = [(1, 0, "V", "supplier"), (2, 0, "C", "customer"), (20, 2, "S", "internal"), (2, 3, "Own", "internal")]


def test_locations_in_two_roles_with_and_without_the_salted_join(frame):
    moves = frame("id bigint, company_id bigint, location_id bigint, location_dest_id bigint",
                  [(i, 2, 20, 2) for i in range(50)] + [(90, 3, 1, 2), (91, 3, 20, 7)])
    locations = frame(LOCATIONS, LOCATION_ROWS)
    small = rows_of(lookups.with_usages(moves, locations))
    salted = rows_of(lookups.with_usages(moves, locations, broadcast_bytes=0))
    assert small == salted and len(small) == 52
    assert rows_of(lookups.with_usages(moves, locations).where("id >= 90"), "id", "src_usage", "dst_usage") == [
        (90, "supplier", "internal"), (91, None, None)]


def test_strict_lookup_ignores_shared_locations(frame):
    moves = frame("id bigint, company_id bigint, location_id bigint, location_dest_id bigint", [(1, 2, 1, 20)])
    found = lookups.with_usages(moves, frame(LOCATIONS, LOCATION_ROWS), strict=True)
    assert rows_of(found, "src_usage", "dst_usage") == [(None, "internal")]


def test_orders_match_by_name_and_company_and_blank_origins_match_none(frame):
    moves = frame("id bigint, company_id bigint, origin string",
                  [(1, 1, "PO1"), (2, 2, "PO1"), (3, 1, ""), (4, 1, None)])
    orders = frame("company_id bigint, name string, partner_id bigint, date_planned timestamp_ntz",
                   [(1, "PO1", 7, T1), (1, "", 8, T1)])
    for limit in (2**62, 0):
        joined = lookups.join_orders(moves, orders, broadcast_bytes=limit)
        assert rows_of(joined, "id", "partner_id", "date_planned") == [
            (1, 7, T1), (2, None, None), (3, None, None), (4, None, None)]


def test_lookup_join_salts_are_hashes_and_keep_every_row(spark):
    facts = spark.range(5000).select("id", F.lit(1).alias("k"))
    dim = spark.range(3).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = lookup_join(facts, dim, ["k"], salt_by="id", broadcast_bytes=0)
    assert "rand" not in joined._jdf.queryExecution().toString()
    assert joined.groupBy("v").count().collect()[0].asDict() == {"v": 10, "count": 5000}


def test_scan_bytes_adds_up_the_tables_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    once = scan_bytes(spark.read.parquet(path))
    table = spark.read.parquet(path)
    assert once > 0 and scan_bytes(table.union(table)) == 2 * once


def test_company_names_default_to_blank(frame):
    facts = frame("company_id bigint", [(1,), (2,)])
    companies = frame("id bigint, name string", [(1, "One")])
    assert rows_of(lookups.with_company_name(facts, companies)) == [(1, "One"), (2, "")]


def test_salted_lookups_match_keys_of_different_types(spark):
    facts = spark.range(3000).select("id", F.lit(1).cast("smallint").alias("k"), F.lit("1").alias("t"))
    dim = spark.range(3).select(F.col("id").alias("k"), F.col("id").alias("t"), (F.col("id") * 10).alias("v"))
    for key in ("k", "t"):
        joined = lookup_join(facts.select("id", key), dim.select(key, "v"), [key], salt_by="id", broadcast_bytes=0)
        assert rows_of(joined.groupBy("v").count()) == [(10, 3000)]
