"""Warehouse geography: warehouses with their base units, from JSON or text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed_values import BASE_UNIT_LABELS
from ..functions.text import place_name, slug

_ENTRY = "array<struct<name:string,base_units:array<string>>>"


def _fail(condition: Column, message: str, value: Column) -> Column:
    return F.when(condition, F.raise_error(F.lit(message)).cast("string")).otherwise(value)


def parse_geo_json(df: DataFrame, text: str = "value") -> DataFrame:
    """Rows (source columns, pos, name, units) of JSON in either form.

    A list of ``{name, base_units}`` objects or an object ``name → units``; NULL units are
    an empty list, anything else is an error.
    """
    value = F.parse_json(F.col(text))
    kind = F.schema_of_variant(value)
    is_list, is_map = kind.startswith("ARRAY"), kind.startswith("OBJECT")
    listed = F.transform(
        F.try_variant_get(value, "$", "array<variant>"),
        lambda item: F.struct(F.try_variant_get(item, "$.name", "string").alias("name"),
                              F.try_variant_get(item, "$.base_units", "variant").alias("units")))
    mapped = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")),
        lambda entry: F.struct(entry["key"].alias("name"), entry["value"].alias("units")))
    entries = F.when(is_list, listed).when(is_map, mapped).otherwise(
        F.raise_error(F.lit("geo JSON: expected object or array")).cast(
            "array<struct<name:string,units:variant>>"))
    others = [c for c in df.columns if c != text]
    rows = df.select(*others, F.posexplode(entries).alias("pos", "entry"))
    units = F.col("entry.units")
    no_units = units.isNull() | F.is_variant_null(units)
    wrong = ~no_units & ~F.schema_of_variant(units).startswith("ARRAY")
    name = _fail(F.col("entry.name").isNull(), "geo JSON: item without a name", F.col("entry.name"))
    name = _fail(F.coalesce(wrong, F.lit(False)), "geo JSON: base units must be a list", name)
    return rows.select(*others, "pos", name.alias("name"),
                       F.when(~no_units, F.try_variant_get(units, "$", "array<string>")).alias("units"))


def parse_geo_text(df: DataFrame, text: str = "value") -> DataFrame:
    """The same rows from lines ``Name: [a, b]``; comments and lines without ``:`` are skipped."""
    line = F.trim(F.col(text))
    kept = df.withColumn(text, line).where(
        (F.col(text) != "") & ~F.col(text).startswith("#") & F.col(text).contains(":"))
    halves = F.split(F.col(text), ":", 2)
    tail = F.trim(F.get(halves, F.lit(1)))
    bare = ~(tail.startswith("[") & tail.endswith("]"))
    tail = _fail(bare, "geo text: missing brackets", tail)
    inner = F.regexp_replace(tail, r"^\[|\]$", "")
    others = [c for c in df.columns if c != text]
    return kept.select(*others, F.get(halves, F.lit(0)).alias("name"), F.split(inner, ",").alias("units"))


def geo_units(parsed: DataFrame, country: Column, keep: list[str] | None = None) -> DataFrame:
    """(country, warehouse_name, slug, base_unit, ord): trimmed, blanks dropped, names made readable.

    A warehouse without units keeps one row with a NULL ``base_unit``.
    """
    units = F.filter(F.coalesce("units", F.array().cast("array<string>")), lambda u: F.trim(u) != "")
    units = F.transform(units, place_name)
    named = parsed.select(
        *(keep or []), F.lower(country).alias("country"), place_name(F.col("name")).alias("warehouse_name"),
        units.alias("units"))
    return named.select(
        *(keep or []), "country", "warehouse_name", slug(F.col("warehouse_name")).alias("slug"),
        F.posexplode_outer("units").alias("ord", "base_unit"))


def _last_wins(parsed: DataFrame, order: str) -> DataFrame:
    """A warehouse listed twice keeps its first place and its last units."""
    key = slug(place_name(F.col("name")))
    places = parsed.withColumn("_slug", key).groupBy("_slug").agg(
        F.min(order).alias("pos"), F.max_by(F.struct("name", "units"), order).alias("entry"))
    return places.select("pos", "entry.name", "entry.units")


def read_geo(spark: SparkSession, path: str, country: str) -> DataFrame:
    """Read a geography file, JSON or ``.txt``, as (country, wh_pos, warehouse_name, slug, base_unit, ord)."""
    if path.endswith(".txt"):
        return read_geo_text(spark, path, country)
    parsed = parse_geo_json(spark.read.text(path, wholetext=True))
    return _units(_last_wins(parsed, "pos"), country)


def read_geo_text(spark: SparkSession, path: str, country: str) -> DataFrame:
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id())
    return _units(_last_wins(parse_geo_text(lines), "line"), country)


def _units(parsed: DataFrame, country: str) -> DataFrame:
    return geo_units(parsed, F.lit(country), ["pos"]).withColumnRenamed("pos", "wh_pos")


def fallback_units(country: Column, count: Column) -> Column:
    """``<Label> 001`` … for warehouses whose units are unknown; the label goes by country."""
    label = None
    for code, text in BASE_UNIT_LABELS.items():
        label = F.when(F.lower(country) == code, text) if label is None else label.when(
            F.lower(country) == code, text)
    label = label.otherwise(F.raise_error(F.concat(F.lit("unsupported country "), country)).cast("string"))
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda i: F.concat(label, F.lit(" "), F.format_string("%03d", i)))
