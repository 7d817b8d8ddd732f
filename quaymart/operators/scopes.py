"""Semi and anti joins, and tagging rows with the windows they fall into."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fixed_values import SUPPLIER_DELAY_DAYS
from .predicates import midnight
from .ranking import top_n


def forecast_scope(abc: DataFrame, scope: str) -> DataFrame | None:
    """(company, product) pairs a forecast is limited to: ``only_class_a`` or ``top_n:<n>``."""
    keys = ["company_id", "product_id"]
    if scope == "only_class_a":
        return abc.where("abc_class = 'A'").select(*keys)
    if scope.startswith("top_n:"):
        number = scope.split(":", 1)[1].strip()
        if number.isdigit() and int(number) > 0:
            order = [F.col("total_value_moved").desc(), *map(F.col, keys)]
            return top_n(abc, order, int(number)).select(*keys)
    return None


def scope_filter(series: DataFrame, scope: DataFrame | None) -> DataFrame:
    """Keep the series in scope; an empty scope means no limit at all.

    Whether the scope is empty is one value that goes to every row, so nothing runs while
    the plan is made.
    """
    if scope is None:
        return series
    keys = ["company_id", "product_id"]
    pairs = scope.select(*keys).distinct().withColumn("_inside", F.lit(True))
    number = pairs.agg(F.count(F.lit(1)).alias("_pairs"))
    marked = series.join(pairs, keys, "left").join(F.broadcast(number))
    return marked.where(F.col("_inside") | (F.col("_pairs") == 0)).select(*series.columns)


def new_tickets(tickets: DataFrame, existing: DataFrame, as_of: dt.date) -> DataFrame:
    """Tickets whose subject has not been opened since the start of the day."""
    open_today = existing.where(F.col("create_date") >= midnight(as_of)).select("name").distinct()
    return tickets.join(open_today, "name", "left_anti")


BUCKET_DAYS = 64
KINDS = ("STOCKOUT", "SUPPLIER_DELAY", "SHRINKAGE")


def window_segments(windows: DataFrame) -> DataFrame:
    """(company, first, last, and a flag per kind): disjoint spans of days with the same anomalies.

    A sweep over the days on which windows start or have ended: what starts and ends on a day
    is summed first, so a company has a row per such day at most, and its running sums say
    how many windows of a kind are open. Days on which no flag changes are passed over.
    """
    kind, first = F.col("kind"), F.col("date")
    lasting = kind.isin("STOCKOUT", "SUPPLIER_DELAY") & (F.col("end_date") >= first)
    last = F.when(lasting, F.col("end_date")).when(kind == "SHRINKAGE", first)
    spans = windows.select("company", "kind", first.alias("first"), last.alias("last")).where("first <= last")
    turn = F.explode(F.array(F.struct(F.col("first").alias("day"), F.lit(1).alias("n")),
                             F.struct(F.date_add("last", 1).alias("day"), F.lit(-1).alias("n")))).alias("turn")
    changes = spans.select("company", "kind", turn).groupBy("company", "turn.day").agg(
        *[F.sum(F.when(kind == name, F.col("turn.n")).otherwise(0)).alias(name) for name in KINDS])
    in_order = Window.partitionBy("company").orderBy("day")
    opened = changes.select("company", "day", *[(F.sum(name).over(in_order) > 0).alias(name) for name in KINDS])
    state = F.struct(*KINDS)
    changed = opened.withColumn("_same", state.eqNullSafe(F.lag(state).over(in_order))).where("NOT _same").drop("_same")
    found = changed.withColumn("last", F.date_sub(F.lead("day").over(in_order), 1))
    return found.where(" OR ".join(KINDS)).select("company", F.col("day").alias("first"), "last", *KINDS)


def tag_windows(
    rows: DataFrame, windows: DataFrame, company: str = "company", day: str = "date", bucket_days: int = BUCKET_DAYS
) -> DataFrame:
    """Add ``is_stockout``, ``delay_add`` and ``is_shrinkage`` from the anomaly windows of the company.

    Stockouts and supplier delays hold from ``date`` to ``end_date`` (none without an end),
    a shrinkage on its own day. The windows are coalesced into disjoint segments, of which a
    row meets those of its company and stretch of ``bucket_days`` days and lies in one at
    most. A row without company or day has no flags.
    """
    def stretch(date):
        return F.floor(F.unix_date(date) / bucket_days)
    segments = window_segments(windows).select(
        F.col("company").alias("_company"), F.col("first").alias("_first"), F.col("last").alias("_last"), *KINDS,
        F.explode(F.sequence(stretch(F.col("first")), stretch(F.col("last")))).alias("_stretch"))
    date = F.col(day).cast("date")
    inside = (F.col(company) == F.col("_company")) & (stretch(date) == F.col("_stretch")) & date.between(
        F.col("_first"), F.col("_last"))
    tagged = rows.join(segments, inside, "left")
    flag = {name: F.coalesce(F.col(name), F.lit(False)) for name in KINDS}
    return tagged.select(
        *[F.col(c) for c in rows.columns], flag["STOCKOUT"].alias("is_stockout"),
        F.when(flag["SUPPLIER_DELAY"], SUPPLIER_DELAY_DAYS).otherwise(0).alias("delay_add"),
        flag["SHRINKAGE"].alias("is_shrinkage"))


def category_vendors(supplierinfo: DataFrame, products: DataFrame, company_id: int) -> DataFrame:
    """Distinct (category, partner_id): vendors of the category's templates, own company or shared."""
    seen = F.coalesce("company_id", F.lit(0)).isin(0, company_id)
    links = (supplierinfo.where(seen & (F.coalesce("partner_id", F.lit(0)) != 0))
             .select("product_tmpl_id", "partner_id").distinct())
    categories = products.where(F.coalesce("product_tmpl_id", F.lit(0)) != 0).groupBy("product_tmpl_id").agg(
        F.max_by("category", "product_id").alias("category"))
    return links.join(categories, "product_tmpl_id").select("category", "partner_id").distinct()


def vendors_by_category(
    supplierinfo: DataFrame, products: DataFrame, categories: DataFrame, company_id: int
) -> DataFrame:
    """category → sorted vendor ids, an empty list for a category without vendors.

    Each pair is made distinct across the cluster before the list of a category is built,
    so a list holds every vendor once however often it is linked.
    """
    lists = (category_vendors(supplierinfo, products, company_id)
             .groupBy("category").agg(F.sort_array(F.collect_list("partner_id")).alias("vendor_ids")))
    return categories.select("category").distinct().join(lists, "category", "left").select(
        "category", F.coalesce("vendor_ids", F.array().cast("array<bigint>")).alias("vendor_ids"))
