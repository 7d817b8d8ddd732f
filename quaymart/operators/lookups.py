"""Many-to-one lookups across companies; none of them changes the number of fact rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import BROADCAST_BYTES, lookup_join
from .versions import latest


def code_or_null(column: str = "default_code") -> Column:
    """A blank product code counts as missing."""
    return F.nullif(F.col(column), F.lit(""))


def scoped_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    values: Mapping[str, Column],
    *,
    fallback_any: bool = True,
    unique: bool = False,
    salt_by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``values`` of the dimension row whose ``id`` is ``fact[key]``.

    ``unique`` says that (id, company_id) is the dimension's version key; without it the
    newest row of each is picked first.

    Per value the own company's row wins, then the shared one (company 0), then, with
    ``fallback_any``, the one of the lowest company id that has the value. The own rows
    and the two fallbacks are each unique slices, so two equi-joins do it.
    """
    one_each = dim if unique else latest(dim, ["id", "company_id"], "write_date")
    rows = one_each.select(
        F.col("id").alias(key), "company_id", *[column.alias(f"_{name}") for name, column in values.items()]
    )
    own = rows.where("company_id <> 0").select(
        key, "company_id", *[F.col(f"_{name}").alias(f"_own_{name}") for name in values]
    )
    shared = F.col("company_id") == 0
    if fallback_any:
        # Company 0 is the lowest, so the minimum by company is "shared, else any".
        picks = [F.min_by(f"_{n}", F.when(F.col(f"_{n}").isNotNull(), F.col("company_id"))).alias(f"_alt_{n}")
                 for n in values]
        other = rows.groupBy(key).agg(*picks)
    else:
        other = rows.where(shared).select(key, *[F.col(f"_{n}").alias(f"_alt_{n}") for n in values])
    options = {"salt_by": salt_by, "broadcast_bytes": broadcast_bytes}
    joined = lookup_join(fact, own, [key, "company_id"], **options)
    joined = lookup_join(joined, other, [key], **options)
    return joined.select(
        *[F.col(c) for c in fact.columns],
        *[F.coalesce(f"_own_{n}", f"_alt_{n}").alias(n) for n in values],
    )


def strict_lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    values: Mapping[str, Column],
    *,
    unique: bool = False,
    salt_by: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Like :func:`scoped_lookup` but only the row of the very same company counts."""
    one_each = dim if unique else latest(dim, ["id", "company_id"], "write_date")
    rows = one_each.select(
        F.col("id").alias(key), "company_id", *[column.alias(name) for name, column in values.items()]
    )
    joined = lookup_join(fact, rows, [key, "company_id"], salt_by=salt_by, broadcast_bytes=broadcast_bytes)
    return joined.select(*fact.columns, *values)


def with_product(fact: DataFrame, products: DataFrame, **options) -> DataFrame:
    """Add ``product_default_code`` ('' if unknown) and ``product_tmpl_id``."""
    found = scoped_lookup(
        fact, products, "product_id",
        {"product_default_code": code_or_null(), "product_tmpl_id": F.col("product_tmpl_id")}, **options)
    return found.withColumn("product_default_code", F.coalesce("product_default_code", F.lit("")))


def with_template_price(fact: DataFrame, templates: DataFrame, **options) -> DataFrame:
    """Second step of the product lookup: add ``standard_price`` of ``product_tmpl_id``, else 0."""
    found = scoped_lookup(
        fact, templates, "product_tmpl_id", {"standard_price": F.col("standard_price")}, unique=True, **options)
    return found.withColumn("standard_price", F.coalesce("standard_price", F.lit(0.0)))


def with_usages(
    moves: DataFrame, locations: DataFrame, *, strict: bool = False, salt_by: str = "id", **options
) -> DataFrame:
    """Look up the location twice: ``src_usage`` of the source, ``dst_usage`` of the destination.

    The customer location alone may be on a third of all moves, hence the salt.
    """
    for key, name in (("location_id", "src_usage"), ("location_dest_id", "dst_usage")):
        values = {name: F.col("usage")}
        if strict:
            moves = strict_lookup(moves, locations, key, values, unique=True, salt_by=salt_by, **options)
        else:
            moves = scoped_lookup(
                moves, locations, key, values, fallback_any=False, unique=True, salt_by=salt_by, **options)
    return moves


def with_company_name(fact: DataFrame, companies: DataFrame, **options) -> DataFrame:
    """Add ``company_name``, '' if the company is unknown."""
    names = companies.select(
        F.col("id").alias("company_id"), F.col("name").alias("company_name"))
    found = lookup_join(fact, names, ["company_id"], salt_by=options.pop("salt_by", None), **options)
    return found.withColumn("company_name", F.coalesce("company_name", F.lit("")))


def join_orders(moves: DataFrame, orders: DataFrame, *, salt_by: str = "id", **options) -> DataFrame:
    """Add ``partner_id`` and ``date_planned`` of the order named in ``origin``, same company.

    Every order of that name counts, as in the plain left join. A move without an origin
    names no order: in place of a name it takes a hash of the row that no order has, which
    spreads such moves over however many tasks there are. A hot origin is left to adaptive
    execution, which splits it.
    """
    nameless = F.concat(F.lit(" "), F.xxhash64(salt_by).cast("string"))
    keyed = moves.withColumn("_document", F.coalesce(F.nullif(F.col("origin"), F.lit("")), nameless))
    keyed = keyed.withColumn("_named", F.coalesce(F.col("origin") != "", F.lit(False)))
    named = orders.where(F.col("name") != "").select(
        F.col("name").alias("_document"), F.lit(True).alias("_named"), "company_id", "partner_id", "date_planned")
    joined = lookup_join(keyed, named, ["_document", "company_id", "_named"], **options)
    return joined.select(*moves.columns, "partner_id", "date_planned")
