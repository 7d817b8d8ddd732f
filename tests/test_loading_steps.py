import datetime as dt

import pytest
from pyspark.sql import functions as F

from quaymart.operators import cleaning, pricing
from quaymart.operators.predicates import active_companies, domain_filter, exclude_companies, within
from quaymart.params import MartParams, parse_id_list, parse_model_list
from quaymart.plans import loading
from quaymart.sources.control import read_watermarks
from tests.conftest import rows_of

DOMAIN_DDL = "id bigint, company_id bigint, state string, active boolean, owner array<string>"
DOMAIN_ROWS = [
    (1, 0, "done", True, ["7", "Seven"]), (2, 2, "draft", False, None), (3, 3, "DONE later", None, ["8", "Eight"]),
    (4, None, "", True, []),
]


@pytest.mark.parametrize("domain, ids", [
    ([], [1, 2, 3, 4]),
    ([["state", "=", "done"]], [1]),
    ([["state", "ilike", "done"]], [1, 3]),
    ([["company_id", "=", False]], [1, 4]),
    ([["company_id", "in", [False, 3]]], [1, 3, 4]),
    ([["company_id", "in", []]], []),
    ([["active", "=", True]], [1, 4]),
    ([["active", "=", False]], [2, 3]),
    (["|", ["id", "=", 1], ["id", ">", 3]], [1, 4]),
    (["|", "|", ["id", "=", 1], ["id", "=", 2], ["id", "=", 3], ["company_id", ">=", 2]], [2, 3]),
    (["&", ["id", ">=", 2], "|", ["state", "=", "draft"], ["active", "=", True]], [2, 4]),
    ([["state", "=", False]], [4]),
    ([["owner", "=", 8]], [3]),
    ([["owner", "=", False]], [2, 4]),
])
def test_domains(frame, domain, ids):
    assert [r[0] for r in rows_of(domain_filter(frame(DOMAIN_DDL, DOMAIN_ROWS), domain), "id")] == ids


def test_unknown_domain_operators_are_refused(frame):
    with pytest.raises(ValueError):
        domain_filter(frame(DOMAIN_DDL, DOMAIN_ROWS), [["id", "child_of", 1]])


def test_companies(frame):
    companies = frame("id bigint, name string", [(1, "a"), (2, "b"), (3, "c")])
    assert rows_of(active_companies(companies, (1,))) == [(2,), (3,)]
    assert exclude_companies(companies, (), "id").count() == 3


def test_within_is_closed_at_the_start_and_ends_with_the_day(frame):
    df = frame("t timestamp_ntz, p_month string", [
        (dt.datetime(2024, 5, 1), "202405"), (dt.datetime(2024, 4, 30, 23, 59), "202404"),
        (dt.datetime(2024, 5, 31, 23, 59), "202405"), (dt.datetime(2024, 6, 1), "202406")])
    assert [r[0].day for r in rows_of(within(df, "t", dt.date(2024, 5, 31), days=30), "t")] == [1, 31]


LANDED = ("id bigint, company_id array<string>, product_id array<string>, quantity double, state string, "
          "date string, write_date string, active boolean")


def test_normalize(frame):
    df = frame(LANDED, [
        (1, ["2", "Two"], ["7", "P"], 1.5, "done", "2024-01-02 03:04:05", "2024-01-02", True),
        (2, None, [], None, None, "soon", None, False),
        (3, ["x"], None, 0.0, "", "2024-01-02T03:04:05.5", "2024-01-03 00:00:00", None)])
    fields = ["id", "company_id", "product_id", "quantity", "state", "date", "write_date", "active", "origin"]
    assert rows_of(cleaning.normalize(df, fields)) == [
        (1, 2, 7, 1.5, "done", dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2), 1, ""),
        (2, 0, 0, 0.0, "", None, None, 0, ""),
        (3, 0, 0, 0.0, "", dt.datetime(2024, 1, 2, 3, 4, 5, 500000), dt.datetime(2024, 1, 3), None, "")]


def test_attribution_and_gate(frame):
    df = frame("id bigint, company_id bigint, name string", [(1, 0, "a"), (2, 2, ""), (3, 9, "c"), (0, 3, "d")])
    copies = cleaning.attribute_companies(df, [2, 3], copy_shared=True)
    assert rows_of(copies, "id", "company_id") == [(0, 3), (1, 2), (1, 3), (2, 2)]
    kept = cleaning.attribute_companies(df, [2, 3])
    assert rows_of(kept, "id", "company_id") == [(0, 3), (1, 0), (2, 2)]
    good, bad = cleaning.require(df, ["id", "name"])
    assert rows_of(good, "id") == [(1,), (3,)] and rows_of(bad, "id") == [(0,), (2,)]


PROPS = "id bigint, company_id bigint, res_id string, value_float double, name string"
PROP_ROWS = [(*row, "standard_price") for row in [
    (1, 0, "product.template,1", 1.0), (2, 0, "product.template,1", 2.0),
    (3, 5, "product.template,1", 3.0), (4, 5, "product.template,1", 4.0), (5, 6, "product.template,1", 5.0),
    (6, 0, "product.template,2", None), (7, 0, "product.template,2", 7.0), (8, 6, "product.template,3", 8.0),
    (9, 0, "broken", 9.0), (10, 0, "product.template,x", 9.0), (11, 0, "product.template,1,2", 9.0),
    (12, 0, "product.product,21", 21.0), (13, 5, "product.product,22", 22.0), (14, 5, "product.product,20", None),
    (15, None, "product.product,41", 41.0), (16, 5, "product.product,40", 40.0),
]] + [(0, 0, "product.template,1", 99.0, "weight_factor"), (99, 5, "product.template,1", 99.0, "weight_factor"),
      (98, 0, "product.template,5", 99.0, None)]


def test_property_prices(frame):
    props = frame(PROPS, PROP_ROWS)
    assert rows_of(pricing.property_prices(props, 5, "product.template")) == [(1, 4.0), (2, 7.0)]
    assert rows_of(pricing.property_prices(props, 7, "product.template")) == [(1, 1.0), (2, 7.0)]
    assert rows_of(pricing.property_prices(props, None, "product.template")) == [(1, 1.0), (2, 7.0), (3, 8.0)]


def test_template_prices_fall_back_to_the_first_priced_variant(frame):
    templates = frame("id bigint, company_id bigint", [(i, 0) for i in (1, 2, 3, 4, 5)])
    products = frame("id bigint, product_tmpl_id bigint",
                     [(20, 3), (21, 3), (22, 3), (40, 4), (41, 4), (10, 1), (99, 0)])
    props = frame(PROPS, PROP_ROWS)
    assert rows_of(pricing.template_prices(templates, products, props, 5)) == [
        (1, 4.0), (2, 7.0), (3, 21.0), (4, 40.0)]
    assert rows_of(pricing.template_prices(templates, products, props, 6)) == [
        (1, 5.0), (2, 7.0), (3, 8.0), (4, 41.0)]


def test_price_repair_and_ladder(frame):
    df = frame("id bigint, standard_price double, list_price double, property_cost double", [
        (1, 5.0, 10.0, None), (2, 0.0, 10.0, None), (3, 5.0, 10.0, 0.0), (4, 0.0, 0.0, None), (5, 0.0, 10.0, 3.0)])
    fixed = pricing.repair_standard_price(df)
    assert rows_of(fixed, "id", "standard_price") == [(1, 5.0), (2, 7.0), (3, 7.0), (4, 0.0), (5, 3.0)]
    prices = frame("list_price double, standard_price double", [(8.0, 4.0), (0.0, 4.0), (8.0, None), (None, 0.0)])
    ladder = prices.select(pricing.price_for("sale").alias("s"), pricing.price_for("purchase").alias("p"))
    assert [tuple(round(v, 6) for v in r) for r in ladder.collect()] == [
        (8.0, 4.0), (5.4, 4.0), (8.0, 6.4), (10.0, 10.0)]


def test_parameters():
    day = dt.date(2024, 1, 1)
    assert MartParams(as_of=day).dead_stock_days == 90
    given = MartParams.from_variables({
        "dead_stock_days": "30", "excluded_company_ids": "[1, \"2\"]", "abc_a_pct": "0.7",
        "full_refresh_models": "[\"product.template\"]", "erp_helpdesk_team_id": "4", "old_helpdesk_team_id": "5"},
        day, team_key="erp_helpdesk_team_id")
    assert (given.dead_stock_days, given.excluded_company_ids, given.abc_a_pct) == (30, (1, 2), 0.7)
    assert given.full_refresh_models == {"product.template"} and given.helpdesk_team_id == 4
    assert parse_id_list("[1, x]") == () and parse_id_list("nothing") == () and parse_id_list("5") == ()
    assert parse_model_list("a.b, c.d") == {"a.b", "c.d"}


def test_no_company_is_one_tasks_work_when_marks_are_looked_up(spark, tmp_path):
    rows = spark.range(50).select((F.col("id") % 2 + 1).alias("company_id"), F.lit(dt.datetime(2024, 1, 5)).cast("timestamp_ntz").alias("write_date"))
    fresh = loading.incremental(rows, read_watermarks(spark, str(tmp_path / "none")), "stock.move")
    assert "hashpartitioning" not in fresh._jdf.queryExecution().executedPlan().toString()
    assert fresh.count() == 50
