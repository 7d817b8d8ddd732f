"""Names, slugs, location names and document keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DOCUMENT_PREFIX, LOCATION_KINDS


def slug(value: Column) -> Column:
    """Upper-case code: blanks, ``-`` and ``/`` become ``_``, all but A-Z, 0-9 and ``_`` goes."""
    joined = F.regexp_replace(F.regexp_replace(_strip(value), r"\s+", "_"), r"[-/]+", "_")
    kept = F.regexp_replace(F.upper(joined), r"[^A-Z0-9_]+", "")
    return F.regexp_replace(F.regexp_replace(kept, r"_+", "_"), r"^_|_$", "")


def _strip(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def readable(value: Column) -> Column:
    """Outer blanks off, inner runs of blanks to one space."""
    return F.regexp_replace(_strip(value), r"\s+", " ")


def place_name(value: Column) -> Column:
    """Readable name; one written in capitals only is turned to title case.

    A capital follows anything that is not a letter, so ``-`` and ``'`` start a new word.
    """
    name = readable(value)
    capitals = (name == F.upper(name)) & (name != F.lower(name))
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    titled = F.array_join(F.transform(parts, F.initcap), "")
    return F.when(capitals, titled).otherwise(name)


def location_parts(name: Column, warehouse: Column) -> Column:
    """``<warehouse>-<kind>-<base>`` as a struct (kind, base), NULL if the name is not of that form."""
    parts = F.split(name, "-")
    kind = F.get(parts, F.lit(1))
    fits = name.startswith(F.concat(F.upper(warehouse), F.lit("-"))) & (F.size(parts) >= 3)
    base = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), "-")
    return F.when(fits & kind.isin(*LOCATION_KINDS), F.struct(kind.alias("kind"), base.alias("base")))


def document_key(
    dataset: Column, country: Column, warehouse: Column, kind: Column, day: Column, seq: Column
) -> Column:
    """``<prefix>/<dataset>/<COUNTRY>/<warehouse>/<kind>/<day>/<seq, 4 digits or more>``."""
    return F.concat_ws(
        "/", F.lit(DOCUMENT_PREFIX), dataset, F.upper(country), warehouse, kind,
        F.date_format(day, "yyyy-MM-dd"), F.format_string("%04d", seq))


def document_parts(key: Column) -> Column:
    """The fields of a document key as a struct; NULL for any other text."""
    parts = F.split(key, "/")
    fits = (F.size(parts) == 7) & (F.get(parts, F.lit(0)) == DOCUMENT_PREFIX)
    return F.when(fits, F.struct(
        F.get(parts, F.lit(1)).alias("dataset"), F.get(parts, F.lit(2)).alias("country"),
        F.get(parts, F.lit(3)).alias("warehouse"), F.get(parts, F.lit(4)).alias("kind"),
        F.get(parts, F.lit(5)).try_cast("date").alias("day"),
        F.get(parts, F.lit(6)).try_cast("int").alias("seq")))


def stable_int(value: Column) -> Column:
    """The first 16 hex digits of the text's SHA-256 as a number, up to 2**64 - 1."""
    return F.conv(F.substring(F.sha2(value.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def stable_id(value: Column) -> Column:
    """A stable id of nine digits for a text."""
    return (stable_int(value) % F.lit(900_000_000).cast("decimal(20,0)") + 100_000_000).cast("bigint")


def percent(value: Column) -> Column:
    return F.format_string("%.2f%%", value * 100)
