"""The ten source models and the reader of their landed records."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import (
    DATE_FIELDS, FIELD_ALIASES, MODEL_DOMAINS, MODEL_FIELDS, MODEL_REQUIRED, QUANTITY_FIELDS, SHARED_MODELS, STRING_FIELDS)
from ..operators.predicates import domain_filter
from ..schemas import RAW_TABLES, TableSpec


@dataclass(frozen=True)
class ModelSpec:
    """What to read from a model, which of it to keep, and the raw table it goes to."""

    model: str
    fields: tuple[str, ...]
    required: tuple[str, ...]
    domain: tuple[Any, ...] = ()
    aliases: dict[str, str] = field(default_factory=dict)
    per_company: bool = True

    @property
    def table(self) -> str:
        return self.model.replace(".", "_")

    @property
    def raw(self) -> TableSpec:
        return RAW_TABLES[self.table]


MODELS: dict[str, ModelSpec] = {
    model: ModelSpec(model, fields, MODEL_REQUIRED[model], MODEL_DOMAINS.get(model, ()), FIELD_ALIASES.get(model, {}),
                     model not in SHARED_MODELS)
    for model, fields in MODEL_FIELDS.items()}


def read_model(
    spark: SparkSession,
    root: str,
    model: str,
    fields: Sequence[str] | None = None,
    domain: Sequence[Any] | None = None,
    *,
    fmt: str = "json",
    newer_than: dt.datetime | None = None,
    files: Sequence[str] | None = None,
    **options: str,
) -> DataFrame:
    """Read a model's landed records: project the fields, keep the rows of the domain.

    ``files`` reads some files of the model's folder only.

    JSON lines are read as variants, because an unset value arrives as ``false`` whatever
    the field's type. Other formats (parquet, or jdbc with ``partitionColumn`` and bounds)
    are typed already; projection and filter are pushed down to them, and so is the bound
    ``newer_than`` on ``write_date``.
    """
    spec = MODELS[model]
    fields = list(fields or spec.fields)
    domain = spec.domain if domain is None else domain
    path = f"{root.rstrip('/')}/{model}" if files is None else list(files)
    if files is not None and not files:
        df = spark.createDataFrame([], ", ".join(f"{name} string" for name in fields))
    elif fmt == "json":
        records = spark.read.options(**options).option("singleVariantColumn", "v").json(path).where("v IS NOT NULL")
        df = records.select(*[_landed("v", name).alias(name) for name in fields])
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(**{"dbtable": spec.table, **options}).load().select(*fields)
    else:
        df = spark.read.format(fmt).options(**options).load(path).select(*fields)
    return domain_filter(newer(df, newer_than), domain)


def landed_lines(spark: SparkSession, files: Sequence[str], model: str) -> DataFrame:
    """The fields of every JSON line of some files, and of broken lines the line as ``broken``, with its ``file``.

    One pass over the files; a caller that needs records and broken lines writes it down once.
    """
    if not files:
        return parse_lines(spark.createDataFrame([], "value string, file string"), model)
    return parse_lines(with_file(spark.read.text(list(files))), model)


def parse_lines(lines: DataFrame, model: str) -> DataFrame:
    """The same of (value, file). Blank lines are left out, which the text alone tells: a filter on the
    parsed value would parse every line once more."""
    parsed = lines.where("trim(value) <> ''").withColumn("v", F.try_parse_json("value"))
    return parsed.select(
        *[_landed("v", name).alias(name) for name in MODELS[model].fields],
        F.when(F.col("v").isNull(), F.col("value")).alias("broken"), "file")


def newer(df: DataFrame, bound: dt.datetime | None) -> DataFrame:
    """Records with a ``write_date`` after a bound."""
    if bound is None:
        return df
    limit = F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    typed = df.schema["write_date"].dataType != T.StringType()
    return df.where((F.col("write_date") if typed else F.col("write_date").try_cast("timestamp_ntz")) > limit)


def with_file(lines: DataFrame) -> DataFrame:
    """(value, file) of lines as the text source gives them."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def malformed_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    value = F.col(text)
    return lines.where(F.try_parse_json(value).isNull() & (F.trim(value) != "")).select(value.alias("value"), "file")


def parse_records(df: DataFrame, model: str, text: str = "value") -> DataFrame:
    """The same columns from JSON text, for records that arrive as lines of a stream."""
    parsed = df.select(F.try_parse_json(F.col(text)).alias("v")).where("v IS NOT NULL")
    return parsed.select(*[_landed("v", name).alias(name) for name in MODELS[model].fields])


def _landed(variant: str, name: str) -> Column:
    """One field of a record as its landing type; ``false`` in place of a value is NULL."""
    value, path = F.col(variant), f"$.{name}"
    if name.endswith("_id"):
        pair = F.try_variant_get(value, path, "array<string>")
        return F.coalesce(pair, F.array(F.try_variant_get(value, path, "bigint").cast("string")))
    if name in STRING_FIELDS:
        inner = F.try_variant_get(value, path, "variant")
        flag = F.schema_of_variant(inner) == "BOOLEAN"
        text = F.try_variant_get(value, path, "string")
        return F.when(flag, F.when(text == "true", F.lit("True"))).otherwise(text)
    if name in QUANTITY_FIELDS or name == "reserved_quantity":
        return F.try_variant_get(value, path, "double")
    if name in DATE_FIELDS:
        return F.try_variant_get(value, path, "string")
    if name == "active":
        return F.try_variant_get(value, path, "boolean")
    return F.try_variant_get(value, path, "bigint")
