"""Queries that write tables, write them again and read them back.

Each works in a new folder below the shared one, on rows made from the given tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymart.operators.sizing import durable, shared_dir
from quaymart.params import MartParams
from quaymart.plans import forecast, loading, marts
from quaymart.plans.tables import Tables, run_sql
from quaymart.sources import control
from quaymart.sources.landing import append_table, ensure_tables, merge_table, read_table, write_mart
from quaymart.sources.report_csv import write_all_reports

Frames = Mapping[str, DataFrame]
CUT = dt.datetime(1996, 1, 1)
CORRECTED_AT = "1999-06-01 00:00:00"
COMPANIES = [2, 3]
LINES = "stock.move.line"


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _spark(t: Frames) -> SparkSession:
    return t["region"].sparkSession


# --- loads ------------------------------------------------------------------------------------------


def corrected(records: DataFrame) -> DataFrame:
    """New versions of every tenth order's lines of before the cut: one more in quantity, forty days later."""
    day = F.col("date").try_cast("timestamp_ntz") + F.expr("INTERVAL 40 DAYS")
    return records.where((F.floor(F.col("id") / 10) % 10 == 0) & (F.col("write_date").cast("timestamp_ntz") < F.lit(CUT).cast("timestamp_ntz"))).withColumns({
        "quantity": F.col("quantity") + 1, "date": F.date_format(day, "yyyy-MM-dd HH:mm:ss"), "write_date": F.lit(CORRECTED_AT)})


def load_twice(t: Frames, landing_rows: Callable[[Frames], DataFrame]) -> str:
    """Land and load the lines before the cut, then the later ones, corrections and broken lines; the root."""
    spark, records = _spark(t), landing_rows(t)
    landing = folder(spark, "landing")
    target, root = f"{landing}/{LINES}", f"{landing}/raw"
    early = F.col("write_date").cast("timestamp_ntz") < F.lit(CUT).cast("timestamp_ntz")

    def load():
        loading.load_landed(spark, landing, LINES, root, company_ids=COMPANIES, copy_shared=True)
    records.where(early).repartition("id").write.json(target)
    load()
    records.where(~early).repartition("id").write.mode("append").json(target)
    corrected(records).write.mode("append").json(target)
    broken = t["orders"].where("o_orderkey % 50 = 0").select(F.format_string('{"id": %d, ', "o_orderkey").alias("value"))
    broken.write.mode("append").text(target)
    load()
    load()  # nothing is new
    return root


def loaded_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(loading.run_log(root)).groupBy("company_id").agg(
        F.sum("rows").alias("rows"), F.sum("invalid_rows").alias("invalid_rows"))


def load_everything(t: Frames, landing_rows: Callable[[Frames], DataFrame], run_at: dt.datetime) -> DataFrame:
    """Two models loaded by one call, the companies in full: the run log, by model and company."""
    spark = _spark(t)
    landing = folder(spark, "landing")
    landing_rows(t).write.json(f"{landing}/{LINES}")
    t["res_company"].select("id", "name", F.lit("1998-01-01 00:00:00").alias("write_date")).coalesce(1).write.json(
        f"{landing}/res.company")
    root = f"{landing}/raw"
    loading.load_all(spark, landing, root, company_ids=COMPANIES, refresh=frozenset({"res.company"}), run_at=run_at)
    stamped = read_table(spark, root, "res_company").groupBy("write_date").agg(F.count(F.lit(1)).alias("companies"))
    log = spark.read.parquet(loading.run_log(root)).select("model", "company_id", "rows", "invalid_rows")
    return log.join(F.broadcast(stamped.select(F.col("write_date").alias("restamped"), "companies")), F.col("model") == "res.company", "left")


# --- merges, marts and names ----------------------------------------------------------------------------


def merged_moves(t: Frames, root: str) -> None:
    """All moves, then newer versions of some in another month, then older versions of others."""
    spark, moves = _spark(t), t["stock_move"]
    merge_table(spark, root, "stock_move", moves)
    some = durable(moves.where("id % 20 IN (1, 2)"))
    later = some.where("id % 20 = 1").withColumns({
        "quantity_done": F.col("quantity_done") + 1, "date_done": F.col("date_done") + F.expr("INTERVAL 60 DAYS"),
        "write_date": F.col("write_date") + F.expr("INTERVAL 400 DAYS")})
    older = some.where("id % 20 = 2").withColumns({
        "quantity_done": F.lit(-1.0), "date_done": F.col("date_done") - F.expr("INTERVAL 60 DAYS"),
        "write_date": F.col("write_date") - F.expr("INTERVAL 1 DAY")})
    merge_table(spark, root, "stock_move", later)
    merge_table(spark, root, "stock_move", older)
    merge_table(spark, root, "stock_move", later)


def merge_stored(t: Frames) -> DataFrame:
    root = folder(_spark(t), "raw")
    merged_moves(t, root)
    return read_table(_spark(t), root, "stock_move").select(
        "id", "company_id", "product_id", "quantity_done", "date_done", "write_date", "origin", "p_month")


def append_read(t: Frames) -> DataFrame:
    root, partners = folder(_spark(t), "raw"), t["res_partner"]
    append_table(partners.where("id % 2 = 0"), root, "res_partner")
    append_table(partners.where("id % 2 = 1"), root, "res_partner")
    return read_table(_spark(t), root, "res_partner").select("id", "company_id", "name", "supplier_rank")


def mart_rerun(t: Frames, params: MartParams) -> DataFrame:
    """A mart written in full, then one year again, then all from a month on that has a last month now."""
    root = folder(_spark(t), "marts")
    rating = durable(marts.vendor_rating(t, params))
    write_mart(rating, root, "vendor_rating")
    write_mart(rating.where("year(month) = 1995").withColumn("overall_score", F.lit(0.5)), root, "vendor_rating")
    some = rating.where("month >= DATE '1997-01-01' AND month < DATE '1997-07-01'")
    for _ in range(2):
        write_mart(some, root, "vendor_rating", complete_from=dt.date(1997, 1, 1))
    return read_table(_spark(t), root, "vendor_rating")


def forecast_rerun(t: Frames, params: MartParams) -> DataFrame:
    """A forecast, and that of every second product again."""
    root = folder(_spark(t), "marts")
    made = durable(forecast.demand_forecast(t, params))
    write_mart(made, root, "demand_forecast")
    again = made.where("product_id % 2 = 0").withColumn("forecast_qty", F.col("forecast_qty") + 1)
    for _ in range(2):
        write_mart(again, root, "demand_forecast")
    return read_table(_spark(t), root, "demand_forecast").drop("p_month")


def named_tables(t: Frames) -> DataFrame:
    """Names made before anything is written, read after several writes."""
    spark = _spark(t)
    root = folder(spark, "raw")
    ensure_tables(spark, root)
    append_table(t["res_company"], root, "res_company")
    merged_moves(t, root)
    return spark.sql("""
        SELECT c.name, m.p_month, count(*) AS moves, sum(m.quantity_done) AS qty
        FROM raw_stock_move m JOIN raw_res_company c ON c.id = m.company_id
        WHERE m.p_month >= '199501' GROUP BY c.name, m.p_month""")


def liquidation_stored(t: Frames, params: MartParams, landing_rows: Callable[[Frames], DataFrame]) -> DataFrame:
    """Dead stock from loaded lines, after a load that moved and corrected some; by the days kept for each month."""
    spark, root = _spark(t), load_twice(t, landing_rows)
    stored = Tables.from_root(spark, root)
    given = {name: t[name] for name in ("stock_quant", "stock_location", "product_product", "product_template", "res_company")}
    lines = {name: stored[name] for name in ("stock_move_line", "movement_days")}
    return marts.liquidation_candidates(Tables.of(**given, **lines), params).select(
        "company_id", "product_id", "last_movement_date", "days_since_last_move", "on_hand_qty")


# --- the rest -------------------------------------------------------------------------------------------


def reset_marks(t: Frames, marks: DataFrame) -> DataFrame:
    """Marks saved, some moved on, then all reset: what a load would start from."""
    spark = _spark(t)
    path = f"{folder(spark, 'raw')}/_watermarks"
    control.save_watermarks(marks, path)
    control.save_watermarks(marks.where("company_id = 2").withColumn("watermark", F.lit(CUT).cast("timestamp_ntz")), path)
    moved = durable(control.read_watermarks(spark, path))
    control.save_watermarks(control.reset_watermarks(moved.where("company_id <> 3")), path)
    return control.read_watermarks(spark, path)


def report_csv(t: Frames, moves: DataFrame) -> DataFrame:
    """All reports written, those of one country again without a dataset's rows, and read back."""
    spark = _spark(t)
    root = folder(spark, "reports")
    placed = moves.withColumns({
        "country": F.concat(F.lit("c/"), F.col("company").cast("string")), "dataset": F.concat(F.lit("d "), F.col("kind"))})
    write_all_reports(placed, root)
    pickings, lines = write_all_reports(placed.where("company = 2 AND kind = 'OUT' AND qty_done > 10"), root)
    headers = spark.read.option("header", True).csv(pickings).groupBy("country", "dataset").agg(
        F.count(F.lit(1)).alias("pickings"), F.sum(F.col("lines").cast("bigint")).alias("lines"))
    rows = spark.read.option("header", True).csv(lines).groupBy("country", "dataset").agg(
        F.sum(F.col("qty_done").cast("double")).alias("qty"))
    return headers.join(rows, ["country", "dataset"])


def named_parameters(t: Frames, params: MartParams) -> DataFrame:
    return run_sql(_spark(t), """
        SELECT product_id, count(*) AS moves, max(date_done) AS last FROM {moves}
        WHERE date_done < :as_of GROUP BY product_id
        HAVING datediff(:as_of, max(date_done)) > :dead_stock_days""", params, moves=t["stock_move"])
