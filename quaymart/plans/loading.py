"""The incremental loader: read what is new, clean it, gate it, merge it, move the mark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import EPOCH
from ..operators.cleaning import attribute_companies, normalize, rename, required_ok
from ..operators.predicates import domain_filter
from ..operators.pricing import repair_standard_price, with_property_cost
from ..operators.sizing import durable
from ..sources.control import read_watermarks, save_watermarks
from ..sources.landed_files import landed_files, not_taken, note_taken
from ..sources.landing import exists, merge_table
from ..sources.models import MODELS, ModelSpec, landed_lines, newer, read_model
from . import movement_days


def incremental(df: DataFrame, state: DataFrame, model: str, version: str = "write_date") -> DataFrame:
    """Rows newer than the mark of their model and company; a company without a mark starts at the epoch.

    Marks are a row per model and company and are broadcast: a shuffle by company would leave
    one task for each.
    """
    marks = state.where(F.col("model") == model).select("company_id", F.col("watermark").alias("_mark"))
    mark = F.coalesce("_mark", F.lit(EPOCH).cast("timestamp_ntz"))
    joined = df.join(F.broadcast(marks), ["company_id"], "left")
    return joined.where(F.col(version) > mark).select(*df.columns)


def lowest_mark(
    state: DataFrame, model: str, company_ids: Sequence[int], *, shared: bool = True
) -> dt.datetime | None:
    """The earliest of the marks of the companies, as a bound for the source; None if one has no mark yet.

    Marks are a row per model and company, so collecting those of a model is cheap.
    """
    wanted = {*company_ids, *([0] if shared else [])}
    rows = state.where((F.col("model") == model) & F.col("company_id").isin(*wanted)).groupBy("company_id").agg(
        F.max("watermark").alias("watermark")).collect()
    marks = {row["company_id"]: row["watermark"] for row in rows if row["watermark"] is not None}
    return min(marks.values()) if wanted <= set(marks) else None


def full_refresh(df: DataFrame, run_at: dt.datetime, version: str = "write_date") -> DataFrame:
    """All rows, restamped to the run, so that they replace what is stored."""
    return df.withColumn(version, F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz"))


def load_stats(flagged: DataFrame, model: str, version: str = "write_date") -> DataFrame:
    """(model, company_id, rows, invalid_rows, watermark) of rows carrying the gate's ``ok``.

    The mark counts rejected rows too.
    """
    return flagged.groupBy("company_id").agg(
        F.count_if("ok").alias("rows"),
        F.count_if(~F.col("ok")).alias("invalid_rows"),
        F.max(version).alias("watermark"),
    ).select(F.lit(model).alias("model"), "company_id", "rows", "invalid_rows", "watermark")


def advance_watermark(state: DataFrame, stats: DataFrame) -> DataFrame:
    """State after a load: a mark only moves, and only forward, where rows were inserted."""
    moved = stats.where("rows > 0").select(
        "model", "company_id", F.coalesce("watermark", F.lit(EPOCH).cast("timestamp_ntz")).alias("watermark"))
    return (state.select("model", "company_id", "watermark").unionByName(moved)
            .groupBy("model", "company_id").agg(F.max("watermark").alias("watermark")))


def prepare(
    records: DataFrame,
    spec: ModelSpec,
    *,
    company_ids: Sequence[int] | None = None,
    copy_shared: bool = False,
    state: DataFrame | None = None,
    refresh_at: dt.datetime | None = None,
    products: DataFrame | None = None,
    properties: DataFrame | None = None,
) -> DataFrame:
    """Landed records to rows of the raw table plus ``read_at`` (the record's own version) and ``ok``.

    One lazy plan for all companies; with ``company_ids`` each of them gets its own copy of
    the shared records (see ``copy_shared``), without it records keep their company. ``refresh_at`` turns the
    incremental filter off.
    """
    rows = normalize(records, spec.fields)
    if "company_id" not in rows.columns:
        rows = rows.withColumn("company_id", F.lit(0).cast("bigint"))
    if spec.per_company and company_ids is not None:
        rows = attribute_companies(rows, company_ids, copy_shared=copy_shared)
    if refresh_at is None and state is not None:
        rows = incremental(rows, state, spec.model)
    rows = rename(rows.withColumn("read_at", F.col("write_date")), spec.aliases)
    if spec.model == "product.template":
        if products is not None and properties is not None:
            rows = with_property_cost(rows, products, properties)
        else:
            rows = rows.withColumn("property_cost", F.lit(None).cast("double"))
        rows = repair_standard_price(rows)
    if refresh_at is not None:
        rows = full_refresh(rows, refresh_at)
    return rows.withColumn("ok", required_ok(rows.schema, spec.required))


def load_model(
    spark: SparkSession,
    records: DataFrame,
    model: str,
    root: str,
    *,
    company_ids: Sequence[int] | None = None,
    copy_shared: bool = False,
    refresh_at: dt.datetime | None = None,
    products: DataFrame | None = None,
    properties: DataFrame | None = None,
    use_marks: bool = True,
    malformed: DataFrame | None = None,
) -> DataFrame:
    """Run one load into the raw table under ``root`` and return its statistics.

    The mark is saved after the merge, so a load that stops is simply run again. ``malformed``
    are landed lines that could not be read, with their files: those not kept yet are kept
    under ``_malformed`` and counted as invalid rows of no company. The statistics are
    appended to the run log, before the lines are kept: a load that stops between counts twice.
    """
    spec = MODELS[model]
    marks = f"{root.rstrip('/')}/_watermarks"
    state = read_watermarks(spark, marks)
    flagged = durable(prepare(
        records, spec, company_ids=company_ids, copy_shared=copy_shared, state=state if use_marks else None,
        refresh_at=refresh_at, products=products, properties=properties))
    merge_table(spark, root, spec.table, flagged.where("ok"))
    if spec.table == movement_days.LINES:
        movement_days.refresh(spark, root)
    stats = load_stats(flagged, model, "read_at")
    if malformed is not None:
        kept = f"{root.rstrip('/')}/_malformed/{spec.table}"
        broken = durable(not_kept(spark, malformed, kept))
        bad = broken.agg(F.count(F.lit(1)).alias("n")).where("n > 0")
        stats = stats.unionByName(bad.select(
            F.lit(model).alias("model"), F.lit(None).cast("bigint").alias("company_id"), F.lit(0).cast("bigint").alias("rows"),
            F.col("n").alias("invalid_rows"), F.lit(None).cast("timestamp_ntz").alias("watermark")))
    stats = durable(stats)
    stats.write.mode("append").parquet(run_log(root))
    if malformed is not None:
        broken.write.mode("append").parquet(kept)
    if refresh_at is None and use_marks:
        advanced = advance_watermark(state, stats)
        changed = advanced.where(F.col("model") == model).exceptAll(state)
        save_watermarks(durable(changed), marks)
    return stats


def not_kept(spark: SparkSession, malformed: DataFrame, kept: str) -> DataFrame:
    """(value, file) of the lines that are not under ``kept`` yet; of equal lines of a file, as many as are missing there."""
    lines = ["value", "file"]
    found = malformed.groupBy(*lines).agg(F.count(F.lit(1)).alias("n"))
    if exists(spark, kept):
        known = spark.read.schema("value string, file string").parquet(kept).groupBy(*lines).agg(
            F.count(F.lit(1)).alias("known"))
        found = found.join(known, lines, "left").withColumn("n", F.col("n") - F.coalesce("known", F.lit(0)))
    return found.where("n > 0").select(*lines, F.explode(F.sequence(F.lit(1), "n")).alias("copy")).drop("copy")


def run_log(root: str) -> str:
    """Folder of the statistics of all loads."""
    return f"{root.rstrip('/')}/_run_log"


def load_landed(
    spark: SparkSession,
    landing: str,
    model: str,
    root: str,
    *,
    company_ids: Sequence[int],
    copy_shared: bool = False,
    refresh_at: dt.datetime | None = None,
    fmt: str = "json",
    **options,
) -> DataFrame:
    """Load what is new in a landing folder: files not taken before, and of these what is after the lowest mark.

    The log of files makes a load open new and changed files only, each once: records and
    lines that are no JSON come from one pass. A full refresh takes all files, and so does
    the first load that asks for a company. Shared records and companies are asked for
    alike. The files are logged last, so a load that stops takes them again; what it had
    merged or kept by then does not change anything. A JDBC source has no files; there the
    bound alone limits what is read.
    """
    spec, base = MODELS[model], root.rstrip("/")
    bound = None
    if refresh_at is None:
        state = read_watermarks(spark, f"{base}/_watermarks")
        bound = lowest_mark(state, model, company_ids, shared=not copy_shared)
    common = {"company_ids": company_ids, "copy_shared": copy_shared, "refresh_at": refresh_at, **options}
    if fmt == "jdbc":
        return load_model(spark, read_model(spark, landing, model, fmt=fmt, newer_than=bound), model, root, **common)
    log = f"{base}/_files/{spec.table}"
    files = landed_files(spark, f"{landing.rstrip('/')}/{model}")
    if refresh_at is None:
        files = not_taken(spark, files, log, company_ids)
    files = durable(files)
    paths = [row["path"] for row in files.select("path").collect()]  # as Spark's own reader lists them
    if fmt == "json":
        lines = durable(landed_lines(spark, paths, model))
        records = domain_filter(newer(lines.where("broken IS NULL").drop("broken", "file"), bound), spec.domain)
        broken = lines.where("broken IS NOT NULL").select(F.col("broken").alias("value"), "file")
        stats = load_model(spark, records, model, root, malformed=broken, **common)
    else:
        records = read_model(spark, landing, model, fmt=fmt, newer_than=bound, files=paths)
        stats = load_model(spark, records, model, root, **common)
    note_taken(files, log, company_ids)
    return stats


def load_all(
    spark: SparkSession, landing: str, root: str, *, company_ids: Sequence[int], refresh: frozenset[str] = frozenset(),
    run_at: dt.datetime, fmt: str = "json", **options,
) -> list[DataFrame]:
    """Every model with a landing folder, one after the other; those in ``refresh`` in full, restamped to the run."""
    return [
        load_landed(spark, landing, model, root, company_ids=company_ids, fmt=fmt,
                    refresh_at=run_at if model in refresh else None, **options)
        for model in MODELS if exists(spark, f"{landing.rstrip('/')}/{model}")]
