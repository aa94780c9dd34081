"""Small text, date and type helpers. Each one is a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: type names that mark a spatial column.
SPATIAL_TYPE_PATTERN = "(?i)BLOB|GEOMETRY|WKB"


def blank(col: Column) -> Column:
    """True for NULL, empty or all-space text."""
    return F.coalesce(F.trim(col) == "", F.lit(True))


def not_blank(col: Column) -> Column:
    return ~blank(col)


def title_or_name(comment: Column, name: Column) -> Column:
    """The comment if it says anything, else the name."""
    return F.coalesce(F.nullif(F.trim(comment), F.lit("")), name)


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def swap_suffix(name: Column, old: str, new: str) -> Column:
    """Replace a trailing ``old`` by ``new``; other names stay."""
    stem = F.substring(name, F.lit(1), F.length(name) - len(old))
    return F.when(name.endswith(old), F.concat(stem, F.lit(new))).otherwise(name)


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def is_spatial_type(type_name: Column) -> Column:
    return type_name.rlike(SPATIAL_TYPE_PATTERN)


def plain_text(col: Column, data_type: T.DataType) -> Column:
    """Value as text in plain notation, the same on every engine. NULL for nested and binary types."""
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.BinaryType)):
        return F.lit(None).cast("string")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.coalesce(col.try_cast("decimal(38,6)").cast("string"), col.cast("string"))
    return col.cast("string")


# ---- date parts used as partition keys ----

PARTS = ("year", "month", "day", "hour")


def epoch_part(ts: Column, part: str) -> Column:
    """Whole units since 1970-01-01 00:00 of a date or zone-less timestamp."""
    if part == "year":
        return (F.year(ts) - 1970).cast("long")
    if part == "month":
        return ((F.year(ts) - 1970) * 12 + F.month(ts) - 1).cast("long")
    if part == "day":
        return F.unix_date(ts.cast("date")).cast("long")
    if part == "hour":
        return F.unix_date(ts.cast("date")).cast("long") * 24 + F.hour(ts)
    raise ValueError(f"unknown part {part}")


def calendar_part(ts: Column, part: str) -> Column:
    """Calendar value as used in ``year=2025/month=3`` folder names."""
    if part not in PARTS:
        raise ValueError(f"unknown part {part}")
    return {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour}[part](ts)
