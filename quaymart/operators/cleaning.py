"""Cleaning of landed records: typed values, names, company attribution, required fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed_values import DATE_FIELDS, QUANTITY_FIELDS, STRING_FIELDS


def normalize(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Turn landed values into plain scalars; a field the input lacks is an unset one."""
    types = {field.name: field.dataType for field in df.schema.fields}
    return df.select(*[
        _clean(F.col(name) if name in types else F.lit(None), name, types.get(name, T.NullType())).alias(name)
        for name in fields
    ])


def _clean(value: Column, name: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType):  # many-to-one: [id, label]
        value, dtype = F.when(F.size(value) > 0, F.element_at(value, 1)), dtype.elementType
    if name in STRING_FIELDS:
        if isinstance(dtype, T.BooleanType):
            value = F.when(value, F.lit("True"))
        return F.coalesce(value.cast("string"), F.lit(""))
    if name.endswith("_id"):
        return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))
    if name in QUANTITY_FIELDS:
        return F.coalesce(value.try_cast("double"), F.lit(0.0))
    if name in DATE_FIELDS or name.endswith("_date"):
        return as_timestamp(value, dtype)
    if isinstance(dtype, T.BooleanType):
        return value.cast("int")
    return value


def as_timestamp(value: Column, dtype: T.DataType) -> Column:
    """ISO date or datetime text to a timestamp; any other text, or no value, is NULL."""
    if isinstance(dtype, T.StringType):
        return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}"), value.try_cast("timestamp_ntz"))
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.cast("timestamp_ntz")
    return F.lit(None).cast("timestamp_ntz")


def rename(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(aliases))


def attribute_companies(df: DataFrame, company_ids: Sequence[int], *, copy_shared: bool = False) -> DataFrame:
    """All per-company runs at once: own records stay, each company gets a copy of the shared ones.

    Without ``copy_shared`` a shared record stays one row of company 0, which every lookup
    falls back to: the same answers from far fewer rows.
    """
    own = F.nullif(F.col("company_id"), F.lit(0))
    if not copy_shared:
        kept = df.withColumn("company_id", F.coalesce(own, F.lit(0).cast("bigint")))
        return kept.where(F.col("company_id").isin(0, *company_ids))
    everyone = F.array(*[F.lit(c).cast("bigint") for c in company_ids])
    ids = F.when(own.isNull(), everyone).when(own.isin(*company_ids), F.array(own))
    others = [c for c in df.columns if c != "company_id"]
    return df.select(*others, F.explode(ids).alias("company_id")).select(*df.columns)


def required_ok(schema: T.StructType, required: Sequence[str]) -> Column:
    """True where every required field has a value other than 0 and ''."""
    ok = F.lit(True)
    for name in required:
        column, dtype = F.col(name), schema[name].dataType
        filled = column.isNotNull()
        if isinstance(dtype, T.StringType):
            filled = filled & (column != "")
        elif isinstance(dtype, T.NumericType):
            filled = filled & (column != 0)
        ok = ok & filled
    return F.coalesce(ok, F.lit(False))


def require(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split into the rows that pass the required-field gate and those that do not."""
    ok = required_ok(df.schema, required)
    return df.where(ok), df.where(~ok)
