"""Parquet tables: creation, append, idempotent replacement by month, and batch merge.

Every write stages its rows under a run of its own and commits them with one pointer
(:mod:`.pointer`): months that are replaced, added or dropped change together. A raw table
with months keeps an index of its keys, (key, month) in hash buckets, that a merge asks where
older versions lie; it is committed by the same pointer. The pointer also tells whether every
key is there once, as after merges alone; then a merge shuffles no rows but those it may change.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import durable, shuffles_freed
from ..operators.thinning import told, with_keys
from ..operators.versions import latest, merge_batch, merge_distinct
from ..schemas import MART_TABLES, RAW_TABLES, TableSpec, enforce_schema, with_month
from .pointer import Pointer, children, commit, current, exists, next_run, size

__all__ = ["append_table", "ensure_tables", "exists", "merge_forecast", "merge_table", "read_months", "read_table",
           "refresh_table", "table_path", "write_mart"]

KEY_BUCKETS = 32
KEY_RUNS = 8  # runs of a bucket from which they are made one
SMALL_FILES = 8  # files of a month, beyond one for each FILE_BYTES, from which they are made few
FILE_BYTES = 16 * 1024 * 1024
COPY_BYTES = 32 * 1024 * 1024  # a task that copies rows sorts those of so many bytes of files in memory
COMPRESSION = "zstd"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _spec(name: str) -> TableSpec:
    return RAW_TABLES.get(name) or MART_TABLES[name]


def _partitions(spec: TableSpec) -> list[str]:
    """Month, and below it the day for daily snapshots, so that a day is replaced alone."""
    if spec.month_of is None:
        return []
    return ["p_month", "snapshot_date"] if spec.month_of == "snapshot_date" else ["p_month"]


def _month_of(part: str) -> str | None:
    month = part.split("/")[0].removeprefix("p_month=")
    return None if month == NO_MONTH else month


# --- names ------------------------------------------------------------------------------------------


def ensure_tables(spark: SparkSession, root: str) -> list[str]:
    """Name every raw and mart table, so that SQL finds the newest content under ``root``, after later writes too."""
    return [refresh_table(spark, root, name) for name in (*RAW_TABLES, *MART_TABLES)]


def table_name(name: str) -> str:
    return ("raw_" if name in RAW_TABLES else "mart_") + name


def refresh_table(spark: SparkSession, root: str, name: str) -> str:
    """Let the table's name show what the pointer names: a view, replaced in one statement."""
    return _name(spark, root, name, current(spark, table_path(root, name)))


def _name(spark: SparkSession, root: str, name: str, pointer: Pointer) -> str:
    spec, path, named = _spec(name), table_path(root, name), table_name(name)
    wanted = {**spec.columns, **({"p_month": "string"} if spec.month_of else {})}
    columns = ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in wanted.items())
    if pointer.parts:
        # Partitions are told by their folders, so that other runs are not even opened.
        kept = ", ".join(f"'run={run}/{part}'" for part, runs in sorted(pointer.parts.items()) for run in runs)
        levels = ["run", *_partitions(spec)]
        folder = ", '/', ".join(f"'{c}=', coalesce(CAST({c} AS STRING), '{NO_MONTH}')" for c in levels)
        end = "" if spec.month_of else ", '/'"
        body = f"SELECT {columns} FROM parquet.`{path}` WHERE concat({folder}{end}) IN ({kept})"
    else:
        body = "SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {c}" for c, kind in wanted.items()) + " WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {named} TBLPROPERTIES ('folder' = '{path}') AS {body}")
    return named


def _renew_name(spark: SparkSession, root: str, name: str, pointer: Pointer) -> None:
    """After a commit: a name that shows this folder shows its new content."""
    named = table_name(name)
    if spark.catalog.tableExists(named):
        shown = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {named}").collect()}
        if shown.get("folder") == table_path(root, name):
            _name(spark, root, name, pointer)


# --- reading ----------------------------------------------------------------------------------------


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read with the declared schema; filters on ``p_month`` prune whole months."""
    return read_months(spark, root, name, current(spark, table_path(root, name)))


def read_months(
    spark: SparkSession, root: str, name: str, pointer: Pointer, months: Iterable[str | None] | None = None
) -> DataFrame:
    """The content a pointer names, or only its partitions of some months."""
    spec, path = _spec(name), table_path(root, name)
    schema = f"{spec.ddl}, p_month string" if spec.month_of else spec.ddl
    only = None if months is None else set(months)
    folders = [f"{path}/run={run}/{part}".rstrip("/") for part, runs in sorted(pointer.parts.items())
               if only is None or _month_of(part) in only for run in runs]
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(f"{schema}, run string").option("basePath", path).parquet(*folders)
    return found.select(*spec.columns, *(["p_month"] if spec.month_of else []))


# --- writing ----------------------------------------------------------------------------------------


def append_table(df: DataFrame, root: str, name: str) -> int:
    """Append by column name to a raw table and return the number of rows written."""
    spark, path, spec = df.sparkSession, table_path(root, name), _spec(name)
    before = current(spark, path)
    run = next_run(before)
    rows, staged = _stage(enforce_schema(df, spec), path, spec, run)
    parts = {**before.parts, **{part: (*before.parts.get(part, ()), run) for part in staged}}
    keys = {}
    if _indexed(name):  # only appended rows may have a key repeatedly
        keys = _index(spark, root, name, before, run, _staged_keys(spark, root, name, run, staged).distinct(), None)
    _commit(spark, root, name, before, parts, keys)
    return rows


def write_mart(
    df: DataFrame, root: str, name: str, day: dt.date | None = None, *, complete_from: dt.date | None = None
) -> int:
    """Replace the snapshot day, or the months, a result covers; a second run changes nothing.

    With ``day``, a snapshot that came out empty also clears what an earlier run left there.
    ``complete_from`` says that a monthly result is all there is from that month on: older
    files of later months without rows are cleared. Forecasts are merged by their key. All
    of it is one commit.
    """
    if name == "demand_forecast":
        return merge_forecast(df, root, name)
    spec = MART_TABLES[name]

    def gone(part: str) -> bool:
        if day is not None and "snapshot_date" in spec.columns:
            return part == f"p_month={day:%Y%m}/snapshot_date={day:%Y-%m-%d}"
        return complete_from is not None and (_month_of(part) or "") >= f"{complete_from:%Y%m}"
    return _replace(enforce_schema(df, spec), root, name, current(df.sparkSession, table_path(root, name)), gone)


def merge_forecast(df: DataFrame, root: str, name: str = "demand_forecast") -> int:
    """Replace the forecasts of the same company, product and month; the others of those months stay."""
    spec, spark = MART_TABLES[name], df.sparkSession
    fresh = durable(with_month(enforce_schema(df, spec), spec))
    months = [row[0] for row in fresh.select("p_month").distinct().collect()]
    before = current(spark, table_path(root, name))
    kept = read_months(spark, root, name, before, months).join(fresh.select(*spec.keys), list(spec.keys), "left_anti")
    merged = fresh.select(*spec.columns).unionByName(kept.select(*spec.columns))
    return _replace(merged, root, name, before)


def _replace(
    df: DataFrame, root: str, name: str, before: Pointer, gone: Callable[[str], bool] = lambda part: False,
    changed: DataFrame | None = None, *, distinct: bool = False,
) -> int:
    """Stage rows and let them replace the partitions they have and those that are ``gone``.

    ``changed`` has the keys that a merge was about; ``distinct`` says that the table has every key once then.
    """
    spark, path, spec = df.sparkSession, table_path(root, name), _spec(name)
    run = next_run(before)
    rows, staged = _stage(df, path, spec, run)
    parts = {part: runs for part, runs in before.parts.items() if not gone(part)} | {part: (run,) for part in staged}
    keys = {}
    if _indexed(name):
        entries = _staged_keys(spark, root, name, run, staged)
        if changed is not None:
            entries = with_keys(entries, changed.columns, changed)
        keys = _index(spark, root, name, before, run, entries, changed)
    _commit(spark, root, name, before, parts, keys, distinct=distinct)
    return rows


def _stage(
    df: DataFrame, path: str, spec: TableSpec, run: str, copied: DataFrame | None = None
) -> tuple[int, list[str]]:
    """Write the rows of a run; the number of rows and the partitions they make.

    Rebalancing by month lets adaptive execution cut a large month into several files and
    keep a small one in one; inside a file the rows are in key order. Rows to be ``copied``
    come from files of their months and are written by the tasks that read them.
    """
    written, by, spark = Observation(), _partitions(spec), df.sparkSession
    out = with_month(df, spec).hint("rebalance", *by)
    if copied is not None:
        out = out.unionByName(copied)
    out = out.sortWithinPartitions(*by, *[k for k in spec.keys if k not in by])
    # Observed last: an empty result is planned away below this point, count and all.
    out = out.observe(written, F.count(F.lit(1)).alias("rows"))
    folder = f"{path}/run={run}"
    with shuffles_freed(spark, COPY_BYTES if copied is not None else None):
        (out.write.partitionBy(*by) if by else out.write).option("compression", COMPRESSION).parquet(folder)
    staged = [""]
    for level in by:
        staged = [f"{part}/{name}".lstrip("/") for part in staged
                  for name in children(spark, f"{folder}/{part}".rstrip("/")) if name.startswith(f"{level}=")]
    return int(written.get["rows"]), staged


def _commit(
    spark: SparkSession, root: str, name: str, before: Pointer, parts: dict[str, tuple[str, ...]],
    keys: dict[str, tuple[str, ...]], *, distinct: bool = False,
) -> None:
    _renew_name(spark, root, name, commit(spark, table_path(root, name), before, parts, keys, None, distinct))


# --- the key index ----------------------------------------------------------------------------------


def _bucket(spec: TableSpec):
    return F.pmod(F.xxhash64(spec.keys[-1]), F.lit(KEY_BUCKETS)).cast("int")


def _indexed(name: str) -> bool:
    return name in RAW_TABLES and RAW_TABLES[name].month_of is not None


def _entries(spark: SparkSession, path: str, spec: TableSpec, pointer: Pointer, buckets: Iterable[str]) -> DataFrame | None:
    """(keys, p_month, sole, run) of some buckets; None if they have no files."""
    folders = [f"{path}/_keys/run={run}/{bucket}" for bucket in sorted(buckets) for run in pointer.keys.get(bucket, ())]
    if not folders:
        return None
    kinds = ", ".join(f"{k} {spec.columns[k]}" for k in spec.keys)
    return spark.read.schema(f"{kinds}, p_month string, sole boolean, run string, bucket int").option(
        "basePath", f"{path}/_keys").parquet(*folders).drop("bucket")


def _places(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, p_month) of the rows that entries stand for: those of the last merge of a key and what was appended since."""
    every = F.collect_set(F.struct("run", "p_month"))  # a key is in few runs of its bucket
    listed = entries.groupBy(*keys).agg(every.alias("every"), F.max(F.when(F.col("sole"), F.col("run"))).alias("last"))
    valid = F.filter("every", lambda e: F.col("last").isNull() | (e["run"] >= F.col("last")))
    return listed.select(*keys, F.explode(F.array_distinct(F.transform(valid, lambda e: e["p_month"]))).alias("p_month"))


def _staged_keys(spark: SparkSession, root: str, name: str, run: str, staged: Sequence[str]) -> DataFrame:
    """(keys, p_month) of the rows of a staged run."""
    rows = read_months(spark, root, name, Pointer(0, {part: (run,) for part in staged}))
    return rows.select(*_spec(name).keys, "p_month")


def _index(
    spark: SparkSession, root: str, name: str, before: Pointer, run: str, rows: DataFrame, changed: DataFrame | None,
) -> dict[str, tuple[str, ...]]:
    """Write the index entries of a staged run, ``rows`` of (keys, p_month); the runs of every bucket afterwards.

    Without ``changed`` the run's rows were appended or are the first, else ``rows`` are all there
    is of the changed keys (``sole``). Entries are added; a bucket with many runs is written anew. An
    entry may outlive its row, which only costs a merge the look into one more month.
    """
    spec, path = RAW_TABLES[name], table_path(root, name)
    rows = rows.withColumn("sole", F.lit(changed is not None))
    crowded = [bucket for bucket, runs in before.keys.items() if len(runs) >= KEY_RUNS]
    old = _entries(spark, path, spec, before, crowded)
    if old is not None:
        # What they stood for becomes one entry each, as if appended now, which a merge's own entries replace.
        places = _places(old, spec.keys).withColumn("sole", F.lit(False)).select(*rows.columns)
        if changed is not None:
            places = with_keys(places, changed.columns, changed, "left_anti")
        rows = rows.unionByName(places)
    folder = f"{path}/_keys/run={run}"
    with shuffles_freed(spark):
        (rows.withColumn("bucket", _bucket(spec)).hint("rebalance", "bucket").sortWithinPartitions("bucket", *spec.keys)
         .write.partitionBy("bucket").option("compression", COMPRESSION).parquet(folder))
    fresh = [bucket for bucket in children(spark, folder) if bucket.startswith("bucket=")]
    return {**{b: runs for b, runs in before.keys.items() if b not in crowded},
            **{b: ((*before.keys.get(b, ()), run) if b not in crowded else (run,)) for b in fresh}}


def _months_of(spark: SparkSession, path: str, spec: TableSpec, before: Pointer, rows: DataFrame, keys: list[str]) -> list[str | None]:
    """The months that hold rows with the keys of a batch; only the batch's buckets are read."""
    buckets = set(before.keys)
    if spec.keys[-1] in keys:
        buckets &= {f"bucket={r[0]}" for r in rows.select(_bucket(spec)).distinct().collect()}
    entries = _entries(spark, path, spec, before, buckets)
    if entries is None:
        return []
    found = with_keys(entries, keys, rows.select(*keys))
    return [r[0] for r in _places(found, spec.keys).select("p_month").distinct().collect()]


def merge_table(
    spark: SparkSession, root: str, name: str, batch: DataFrame, keys: Sequence[str] | None = None
) -> int:
    """Merge a batch into a raw table, rewriting only the months it touches, once.

    Touched are the months of the batch rows and the months that hold older versions of
    their keys, since a row may have moved from one month to another; the key index tells
    them, so other months are not read. A run that stops half way changes nothing. ``keys``
    replaces the declared key, as ``["id"]`` where a record may change its company or product
    and should not survive under the old one. Where the table is known to have every key
    once, only rows that the batch really changes are merged, and only their months rewritten.
    """
    spec, path = RAW_TABLES[name], table_path(root, name)
    keys = list(keys or spec.keys)
    before, fresh = current(spark, path), enforce_schema(batch, spec)
    narrow = set(keys) <= set(spec.keys)  # rows that differ in these differ in the declared key
    if spec.month_of is None:
        existing = read_months(spark, root, name, before)
        return _replace(merge_batch(existing, fresh, keys, spec.version), root, name, before)
    if not before.parts:  # nothing to merge with: the newest version of every key is the table
        return _replace(latest(fresh, keys, spec.version), root, name, before, distinct=narrow)
    rows = durable(with_month(latest(fresh, keys, spec.version), spec))
    touched = {r[0] for r in rows.select("p_month").distinct().collect()}
    touched |= set(_months_of(spark, path, spec, before, rows, keys))
    if before.distinct and set(keys) == set(spec.keys):
        return _merge_changes(spark, root, name, before, rows, touched)
    existing = read_months(spark, root, name, before, touched).select(*spec.columns)
    merged = merge_batch(existing, rows.select(*spec.columns), keys, spec.version)
    return _replace(
        merged, root, name, before, lambda part: _month_of(part) in touched, rows.select(*keys),
        distinct=narrow and (before.distinct or all(_month_of(part) in touched for part in before.parts)))


def _merge_changes(
    spark: SparkSession, root: str, name: str, before: Pointer, rows: DataFrame, touched: set[str | None]
) -> int:
    """Merge a batch, one row for each key, into a table with one row for each key.

    Only the rows of the table that may have a key of the batch are merged with it. Nothing is
    written if nothing of the batch wins; else the months that gain or lose a row are, their
    other rows copied by the tasks that read them, so that a merge shuffles rows by the size of
    the batch. Months that fell into many small files are rebalanced.
    """
    spec, path = RAW_TABLES[name], table_path(root, name)
    columns, keys = list(spec.columns), list(spec.keys)

    def existing(months: Iterable[str | None], perhaps: bool) -> DataFrame:
        marked = told(read_months(spark, root, name, before, months), keys, rows)
        return marked.where("_perhaps" if perhaps else "NOT _perhaps").drop("_perhaps")

    merged = merge_distinct(existing(touched, True), rows, keys, spec.version, "p_month")
    changed = merged.where("NOT _held")
    months = {r[0] for r in changed.select("p_month").unionAll(changed.where("_old IS NOT NULL").select("_old.p_month")).distinct().collect()}
    if not months:
        return 0
    old = {part: runs for part, runs in before.parts.items() if _month_of(part) in months}
    small = {_month_of(part) for part, runs in old.items() if _in_small_files(spark, path, part, runs)}
    here = F.coalesce(F.col("p_month"), F.lit(NO_MONTH)).isin(*[m or NO_MONTH for m in months])
    moved = merged.where(here).select(*columns)
    if small:
        moved = moved.unionByName(existing(small, False).select(*columns))
    run = next_run(before)
    count, staged = _stage(moved, path, spec, run, existing(months - small, False))
    parts = {part: runs for part, runs in before.parts.items() if part not in old} | {part: (run,) for part in staged}
    index = _index(spark, root, name, before, run, changed.select(*keys, "p_month"), changed.select(*keys))
    _commit(spark, root, name, before, parts, index, distinct=True)
    return count


def _in_small_files(spark: SparkSession, path: str, part: str, runs: Sequence[str]) -> bool:
    """Whether merges have left a partition in many more files than its bytes ask for."""
    files, length = map(sum, zip(*[size(spark, f"{path}/run={run}/{part}") for run in runs], strict=True))
    return files >= SMALL_FILES + length // FILE_BYTES
