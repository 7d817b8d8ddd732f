"""Row filters shared by the loader and the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exclude_companies(df: DataFrame, ids: Sequence[int], column: str = "company_id") -> DataFrame:
    """Drop the rows of excluded companies; an empty list drops nothing."""
    return df.where(~F.col(column).isin(*ids)) if ids else df


def active_companies(companies: DataFrame, excluded: Sequence[int]) -> DataFrame:
    """Ids of all companies that are not excluded."""
    return exclude_companies(companies, excluded, "id").select("id").distinct()


def midnight(day: dt.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def until(df: DataFrame, column: str, as_of: dt.date) -> DataFrame:
    """Rows up to the end of the ``as_of`` day."""
    bounded = df.where(F.col(column) < midnight(as_of + dt.timedelta(days=1)))
    return _prune(bounded, F.col("p_month") <= as_of.strftime("%Y%m"))


def since(df: DataFrame, column: str, start: dt.date | Column) -> DataFrame:
    """Rows from the start of a day on."""
    first = F.lit(start) if isinstance(start, dt.date) else start
    bounded = df.where(F.col(column) >= first.cast("timestamp_ntz"))
    return _prune(bounded, F.col("p_month") >= F.date_format(first, "yyyyMM"))


def within(df: DataFrame, column: str, as_of: dt.date, *, days: int = 0, months: int = 0) -> DataFrame:
    """Rows from ``as_of`` minus the span to the end of ``as_of``."""
    start = F.date_sub(F.add_months(F.lit(as_of), -months), days)
    return since(until(df, column, as_of), column, start)


def _prune(df: DataFrame, condition: Column) -> DataFrame:
    """Repeat a date bound on the month partition, so that the scan skips whole months."""
    return df.where(condition) if "p_month" in df.columns else df


def domain_filter(df: DataFrame, domain: Sequence[Any]) -> DataFrame:
    """Apply a prefix-notation domain: triples, ``'|'`` and ``'&'``; neighbours are ANDed."""
    condition = domain_condition(df.schema, domain)
    return df if condition is None else df.where(condition)


def domain_condition(schema: T.StructType, domain: Sequence[Any]) -> Column | None:
    operands: list[Column] = []
    for token in reversed(list(domain)):
        if token in ("|", "&"):
            left, right = operands.pop(), operands.pop()
            operands.append(left | right if token == "|" else left & right)
        else:
            name, operator, value = token
            operands.append(_term(schema[name].dataType, F.col(name), operator, value))
    if not operands:
        return None
    condition = operands.pop()
    while operands:
        condition = condition & operands.pop()
    return condition


def _unset(dtype: T.DataType, column: Column) -> Column:
    """``False`` in a domain: no value, which the raw tables store as 0 or the empty string."""
    if isinstance(dtype, T.BooleanType):
        return column.isNull() | ~column
    if isinstance(dtype, T.StringType):
        return column.isNull() | (column == "")
    if isinstance(dtype, T.NumericType):
        return column.isNull() | (column == 0)
    return column.isNull()


def _term(dtype: T.DataType, column: Column, operator: str, value: Any) -> Column:
    if isinstance(dtype, T.ArrayType):  # a landed many-to-one pair: compare its id
        column, dtype = F.get(column, 0).try_cast("bigint"), T.LongType()
    if operator == "=":
        if value is False or value is None:
            return _unset(dtype, column)
        if value is True and isinstance(dtype, T.NumericType):
            value = 1
        return column == F.lit(value)
    if operator == "in":
        listed = [item for item in value if item is not False and item is not None]
        matches = column.isin(*listed) if listed else F.lit(False)
        return matches | _unset(dtype, column) if len(listed) < len(value) else matches
    if operator == "ilike":
        return column.ilike(f"%{value}%")
    if operator == ">":
        return column > F.lit(value)
    if operator == ">=":
        return column >= F.lit(value)
    raise ValueError(f"unsupported domain operator {operator!r}")
