"""Cost prices: company-scoped properties, repair of missing costs, price ladders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import COST_SHARE_OF_LIST, DEFAULT_PRICE, PRICE_PROPERTY, PURCHASE_SHARE, SALE_MARKUP
from .sizing import lookup_join


def _priced_records(props: DataFrame, model: str) -> DataFrame:
    """Cost properties of one model, the record id taken from ``model,id``; bad ids and NULLs skipped.

    A record has other numeric properties too: only those named as the cost are prices.
    """
    ref = F.split("res_id", ",", 2)
    priced = (F.col("name") == PRICE_PROPERTY) & F.col("value_float").isNotNull()
    return (props.where(priced & F.col("res_id").startswith(f"{model},"))
            .select("id", F.coalesce("company_id", F.lit(0)).alias("company_id"),
                    F.trim(F.get(ref, F.lit(1))).try_cast("bigint").alias("record_id"),
                    F.col("value_float").cast("double").alias("price"))
            .where("record_id IS NOT NULL"))


def property_prices(props: DataFrame, company_id: int | None, model: str) -> DataFrame:
    """(record_id, price) as one company sees it.

    Its own property wins (the last by id), else the first shared one. Without a company
    the first property of any company is taken.
    """
    rows = _priced_records(props, model)
    if not company_id:
        return rows.groupBy("record_id").agg(F.min_by("price", "id").alias("price"))
    own = F.col("company_id") == company_id
    return rows.where(own | (F.col("company_id") == 0)).groupBy("record_id").agg(
        F.coalesce(F.max_by("price", F.when(own, F.col("id"))), F.min_by("price", "id")).alias("price"))


def _own_and_shared(props: DataFrame, model: str) -> tuple[DataFrame, DataFrame]:
    """The same rule for all companies at once: (record_id, company_id, own), (record_id, shared)."""
    rows = _priced_records(props, model)
    own = (rows.where("company_id <> 0").groupBy("record_id", "company_id")
           .agg(F.max_by("price", "id").alias("own")))
    shared = rows.where("company_id = 0").groupBy("record_id").agg(F.min_by("price", "id").alias("shared"))
    return own, shared


def with_property_cost(templates: DataFrame, products: DataFrame, props: DataFrame) -> DataFrame:
    """Add ``property_cost`` per (id, company_id): the template's property, else a variant's.

    Among the variants the lowest product id that has a price for the company counts.
    """
    own, shared = _own_and_shared(props, "product.template")
    own = own.select(F.col("record_id").alias("id"), "company_id", "own")
    shared = shared.select(F.col("record_id").alias("id"), "shared")

    variants = products.groupBy(F.col("id").alias("record_id")).agg(
        F.min("product_tmpl_id").alias("tmpl")).where("tmpl <> 0")
    own_v, shared_v = _own_and_shared(props, "product.product")
    first = F.min_by(F.struct("record_id", "price"), "record_id")
    own_v = (own_v.withColumnRenamed("own", "price").join(variants, "record_id")
             .groupBy(F.col("tmpl").alias("id"), "company_id").agg(first.alias("own_v")))
    shared_v = (shared_v.withColumnRenamed("shared", "price").join(variants, "record_id")
                .groupBy(F.col("tmpl").alias("id")).agg(first.alias("shared_v")))

    joined = templates
    for dim, keys in ((own, ["id", "company_id"]), (shared, ["id"]),
                      (own_v, ["id", "company_id"]), (shared_v, ["id"])):
        joined = lookup_join(joined, dim, keys)
    # A shared price of a lower variant goes before the company's own price of a higher one.
    own_first = F.col("shared_v").isNull() | (F.col("own_v.record_id") <= F.col("shared_v.record_id"))
    variant = F.when(F.col("own_v").isNotNull() & own_first, F.col("own_v.price")).otherwise(
        F.col("shared_v.price"))
    return joined.withColumn("property_cost", F.coalesce("own", "shared", variant)).select(
        *[F.col(c) for c in templates.columns], "property_cost")


def template_prices(
    templates: DataFrame, products: DataFrame, props: DataFrame, company_id: int
) -> DataFrame:
    """(template_id, price) as one company sees it; templates without any price are left out."""
    ids = templates.select("id").distinct().withColumn("company_id", F.lit(company_id).cast("bigint"))
    return (with_property_cost(ids, products, props)
            .where("property_cost IS NOT NULL")
            .select(F.col("id").alias("template_id"), F.col("property_cost").alias("price")))


def repair_standard_price(df: DataFrame, override: str = "property_cost") -> DataFrame:
    """Take the property cost if there is one; a cost of 0 becomes a share of the list price."""
    cost = F.coalesce(F.col(override), F.col("standard_price"))
    usable = F.coalesce(F.col("list_price"), F.lit(0.0)) != 0
    return df.withColumn(
        "standard_price",
        F.when((cost == 0) & usable, F.col("list_price") * COST_SHARE_OF_LIST).otherwise(cost)).drop(override)


def price_for(kind: str, list_price: str = "list_price", standard_price: str = "standard_price") -> Column:
    """Unit price of a ``sale`` or ``purchase`` line."""
    listed, cost = F.col(list_price), F.col(standard_price)
    if kind == "sale":
        return F.when(listed > 0, listed).when(cost > 0, cost * SALE_MARKUP).otherwise(F.lit(DEFAULT_PRICE))
    return F.when(cost > 0, cost).when(listed > 0, listed * PURCHASE_SHARE).otherwise(F.lit(DEFAULT_PRICE))
