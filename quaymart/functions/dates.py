"""Calendar days and the seasonal and weekday demand factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import CATEGORY_CURVES, COUNTRY_SEASONS, PULSE_LIMIT, WEEKDAY_FACTORS


def month_of(value: Column) -> Column:
    return F.trunc(value, "month")


def next_month(value: Column) -> Column:
    return F.add_months(F.trunc(value, "month"), 1)


def calendar(df: DataFrame, end: str, days: str, name: str = "day") -> DataFrame:
    """Each row once per day of the ``days`` days ending at ``end``; none for 0 or less."""
    last, count = F.col(end).cast("date"), F.col(days).cast("int")
    run = F.when(count > 0, F.sequence(F.date_sub(last, count - 1), last))
    return df.withColumn(name, F.explode(run))


def _unknown(what: str, value: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"unknown {what} "), F.coalesce(value, F.lit("NULL"))))


def _by_key(key: Column, values: dict[str, object], what: str, dtype: str) -> Column:
    column = None
    for name, value in values.items():
        column = F.when(key == name, F.lit(value)) if column is None else column.when(key == name, F.lit(value))
    return column.otherwise(_unknown(what, key).cast(dtype))


def seasonal_multiplier(country: Column, category: Column, day: Column) -> Column:
    """1 plus the category's amplitude times the pulses of the seasons around ``day``.

    Each season of this and of the last year gives a pulse that ramps up, holds and decays,
    shifted by the category's lag; together they count at most ``PULSE_LIMIT``.
    """
    code = F.lower(country)
    lag, amplitude, ramp, peak, decay = (
        _by_key(category, {name: curve[i] for name, curve in CATEGORY_CURVES.items()}, "category",
                "double" if i == 1 else "int")
        for i in range(5))
    pulses = F.lit(0.0)
    for season in range(2):
        start_month = _by_key(code, {c: s[season][0] for c, s in COUNTRY_SEASONS.items()}, "country", "int")
        start_day = _by_key(code, {c: s[season][1] for c, s in COUNTRY_SEASONS.items()}, "country", "int")
        for years_back in (0, 1):
            start = F.make_date(F.year(day) - years_back, start_month, start_day)
            pulses = pulses + _pulse(F.datediff(day, start) - lag, ramp, peak, decay)
    return 1.0 + amplitude * F.least(pulses, F.lit(PULSE_LIMIT))


def _pulse(since: Column, ramp: Column, peak: Column, decay: Column) -> Column:
    into_decay = since - (ramp + peak)
    return (F.when(since < 0, 0.0)
            .when(since <= ramp, F.try_divide(since.cast("double"), F.greatest(ramp, F.lit(1)).cast("double")))
            .when(since <= ramp + peak, 1.0)
            .when(into_decay <= decay,
                  1.0 - F.try_divide(into_decay.cast("double"), F.greatest(decay, F.lit(1)).cast("double")))
            .otherwise(0.0))


def weekday_multiplier(kind: Column, day: Column) -> Column:
    """Factor of the weekday for a movement kind; an unknown kind is an error."""
    factor = None
    for name, week in WEEKDAY_FACTORS.items():
        value = F.element_at(F.array(*[F.lit(x) for x in week]), F.weekday(day) + 1)
        factor = F.when(kind == name, value) if factor is None else factor.when(kind == name, value)
    return factor.otherwise(_unknown("kind", kind).cast("double"))
