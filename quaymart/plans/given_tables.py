"""The given star-schema tables seen as the raw inventory tables.

Companies are regions, moves are order lines, locations and products are spread over the
companies so that every lookup rule has rows to act on (see FIXTURES.md). The text is the
mapping only; it runs unchanged in Spark SQL and in the checking database.
"""

from __future__ import annotations

import datetime as dt
from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.versions import latest
from ..params import MartParams
from .tables import Tables

AS_OF = dt.date(1998, 6, 15)
PARAMS = MartParams(
    as_of=AS_OF, excluded_company_ids=(1,), dead_stock_days=90, anomaly_pct=0.2, otif_threshold=0.8,
    alert_email="buyer@example.com", helpdesk_team_id=1)

SOURCE_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

MAPPING: dict[str, str] = {
    "res_company": """
SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS name FROM {region}""",
    "res_partner": """
SELECT s_suppkey AS id, CAST(n_regionkey + 1 AS BIGINT) AS company_id, s_name AS name,
       CAST(1 AS BIGINT) AS supplier_rank
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "stock_location": """
SELECT CAST(1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS company_id, 'Vendors' AS name, 'supplier' AS usage
UNION ALL SELECT CAST(2 AS BIGINT), CAST(0 AS BIGINT), 'Customers', 'customer'
UNION ALL SELECT CAST(10 * (r_regionkey + 1) AS BIGINT), CAST(r_regionkey + 1 AS BIGINT), 'Stock', 'internal'
          FROM {region}
UNION ALL SELECT CAST(10 * (r_regionkey + 1) + 1 AS BIGINT), CAST(r_regionkey + 1 AS BIGINT), 'Own vendors',
                 'supplier' FROM {region}""",
    "product_template": """
SELECT p_partkey AS id, CAST(0 AS BIGINT) AS company_id, p_name AS name, p_type AS type,
       CASE WHEN p_partkey % 11 = 0 THEN CAST(0.0 AS DOUBLE) ELSE p_retailprice * CAST(0.6 AS DOUBLE) END
         AS standard_price,
       p_retailprice AS list_price
FROM {part} WHERE p_partkey % 13 <> 0
UNION ALL
SELECT p_partkey, company_id, p_name, p_type, p_retailprice * CAST(0.5 AS DOUBLE), p_retailprice
FROM {part_company} WHERE p_partkey % 4 = 0""",
    "product_product": """
SELECT p_partkey AS id, CAST(0 AS BIGINT) AS company_id, p_partkey AS product_tmpl_id,
       CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_brand || '-' || CAST(p_partkey AS STRING) END AS default_code
FROM {part} WHERE p_partkey % 3 <> 0
UNION ALL
SELECT p_partkey, company_id, p_partkey,
       p_brand || '-' || CAST(p_partkey AS STRING) || '-C' || CAST(company_id AS STRING)
FROM {part_company} WHERE p_partkey % 4 = 0
UNION ALL
SELECT p_partkey, CAST(p_partkey % 5 + 1 AS BIGINT), p_partkey,
       p_brand || '-' || CAST(p_partkey AS STRING) || '-X'
FROM {part} WHERE p_partkey % 3 = 0 AND p_partkey % 4 <> 0""",
    "order_company": """
SELECT o.*, CAST(n_regionkey + 1 AS BIGINT) AS company_id
FROM {orders} o JOIN {customer} ON c_custkey = o_custkey JOIN {nation} ON n_nationkey = c_nationkey""",
    "purchase_order": """
SELECT o_orderkey AS id, company_id, o_custkey % 10 + 1 AS partner_id,
       'PO' || CAST(o_orderkey AS STRING) AS name, o_orderdate AS date_order,
       o_orderdate + INTERVAL 30 DAY AS date_planned, o_orderstatus AS state
FROM {order_company} WHERE o_orderkey % 7 <> 0""",
    "stock_move_raw": """
SELECT l_orderkey * 10 + l_linenumber AS id, company_id, l_partkey AS product_id,
       l_quantity AS product_uom_qty,
       CASE WHEN l_discount > CAST(0.07 AS DOUBLE) THEN l_quantity * CAST(0.5 AS DOUBLE) ELSE l_quantity END
         AS quantity_done,
       CASE l_returnflag WHEN 'A' THEN 10 * company_id + 1 ELSE 10 * company_id END AS location_id,
       CASE l_returnflag WHEN 'N' THEN CAST(2 AS BIGINT) ELSE 10 * company_id END AS location_dest_id,
       CASE l_linestatus WHEN 'F' THEN 'done' ELSE 'assigned' END AS state,
       o_orderdate AS date_expected, l_shipdate AS date_done, 'PO' || CAST(l_orderkey AS STRING) AS origin,
       l_shipdate AS write_date, l_suppkey, l_extendedprice
FROM {lineitem} JOIN {order_company} ON o_orderkey = l_orderkey""",
    "stock_quant_raw": """
SELECT id, company_id, product_id, 10 * company_id AS location_id, product_uom_qty AS quantity,
       CAST(0.0 AS DOUBLE) AS reserved_quantity, write_date, l_suppkey, product_uom_qty, l_extendedprice
FROM {stock_move_raw} WHERE state = 'assigned' AND product_id % 9 <> 0""",
    "stock_valuation_layer_raw": """
SELECT id, company_id, product_id % 20 + 1 AS product_id,
       CASE WHEN id % 10 = 7 THEN CAST(0.0 AS DOUBLE) ELSE product_uom_qty END AS quantity,
       l_extendedprice AS value, date_done AS create_date, write_date, l_suppkey, product_uom_qty, l_extendedprice
FROM {stock_move_raw}""",
    "ir_property": """
SELECT p_partkey * 10 AS id, CAST(0 AS BIGINT) AS company_id, 'standard_price' AS name,
       'product.template,' || CAST(p_partkey AS STRING) AS res_id,
       p_retailprice * CAST(0.55 AS DOUBLE) AS value_float
FROM {part} WHERE p_partkey % 10 IN (0, 1)
UNION ALL SELECT p_partkey * 10 + company_id, company_id, 'standard_price',
                 'product.template,' || CAST(p_partkey AS STRING), p_retailprice * CAST(0.45 AS DOUBLE)
          FROM {part_company} WHERE p_partkey % 10 = 1
UNION ALL SELECT p_partkey * 10 + 7, CAST(0 AS BIGINT), 'standard_price',
                 'product.product,' || CAST(p_partkey AS STRING), p_retailprice * CAST(0.65 AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 = 2
UNION ALL SELECT p_partkey * 10 + 8, CAST(0 AS BIGINT), 'standard_price', 'broken', CAST(1.0 AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 = 3
UNION ALL SELECT p_partkey * 10 + 9, CAST(0 AS BIGINT), 'standard_price',
                 'product.template,' || CAST(p_partkey AS STRING), CAST(NULL AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 = 4
UNION ALL SELECT p_partkey * 10 - 5, CAST(0 AS BIGINT), 'weight_factor',
                 'product.template,' || CAST(p_partkey AS STRING), CAST(99.0 AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 IN (0, 1)
UNION ALL SELECT p_partkey * 10 + 6, CAST(2 AS BIGINT), 'weight_factor',
                 'product.template,' || CAST(p_partkey AS STRING), CAST(98.0 AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 IN (1, 5)
UNION ALL SELECT p_partkey * 10 + 6, CAST(0 AS BIGINT), 'weight_factor',
                 'product.product,' || CAST(p_partkey AS STRING), CAST(97.0 AS DOUBLE)
          FROM {part} WHERE p_partkey % 10 = 2""",
}

# Raw tables that need the version dedupe: keys, and the order of equal versions.
DEDUPED = {
    "stock_move": ("stock_move_raw", ("company_id", "product_id", "id")),
    "stock_quant": ("stock_quant_raw", ("company_id", "product_id", "id")),
    "stock_valuation_layer": ("stock_valuation_layer_raw", ("company_id", "product_id", "id")),
}
COMPANIES = (1, 2, 3, 4, 5)  # one for each region
TIES = ("l_suppkey", "product_uom_qty", "l_extendedprice")

def inputs_of(name: str) -> list[str]:
    """Tables a mapping reads: the placeholders in its text."""
    return sorted({field for _, field, _, _ in Formatter().parse(MAPPING[name]) if field})


def given_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Raw tables, keyed ones with one version per key, over the parquet files in ``sf_dir``."""

    def source(name: str) -> DataFrame:
        return spark.read.schema(SOURCE_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")

    def mapped(name: str) -> DataFrame:
        frames = {used: tables[used] for used in inputs_of(name)}
        if name == "stock_move_raw":
            frames["order_company"] = broadcast_if_small(frames["order_company"])
        return spark.sql(MAPPING[name], **frames)

    def deduped(name: str) -> DataFrame:
        raw, keys = DEDUPED[name]
        return latest(tables[raw], keys, "write_date", TIES).drop("l_suppkey", "l_extendedprice")

    builders = {name: (lambda n=name: source(n)) for name in SOURCE_TABLES}
    builders |= {name: (lambda n=name: mapped(n)) for name in MAPPING}
    builders |= {name: (lambda n=name: deduped(n)) for name in DEDUPED}
    builders["part_company"] = lambda: tables["part"].withColumn(
        "company_id", F.explode(F.lit(list(COMPANIES)).cast("array<bigint>")))
    builders["stock_move_line"] = lambda: tables["stock_move"].withColumnRenamed("quantity_done", "qty_done")
    tables = Tables(builders)
    return tables
