"""Scalar helpers: Column in, Column out, all inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marketplace or currency code to country.
COUNTRY = {
    "Amazon.co.mx": "Mexico",
    "Amazon.ca": "Canada",
    "Amazon.co.uk": "United Kingdom",
    "Amazon.com": "United States",
    "USD": "United States",
    "CAD": "Canada",
    "INR": "India",
    "UK": "United Kingdom",
    "US": "United States",
}

# The cast names of nested fields and their Spark types.
LEAF_TYPES = {"string": "string", "integer": "bigint", "numeric": "decimal(38,9)"}

# A date, a time of day and something after it.
_ZONED = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\s*\d{1,2}(?::\d{1,2}){1,2}(?:\.\d*)?\s*[^\d\s.:]"


def _to_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def default_key(col: Column | str, value: object = "N/A") -> Column:
    return F.coalesce(_to_column(col), F.lit(value))


def country_name(col: Column | str) -> Column:
    col = _to_column(col)
    table = F.create_map(*[F.lit(x) for pair in COUNTRY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, col), col)


def _from_epoch(unit: str, amount: Column) -> Column:
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add(unit, amount, epoch)


def as_utc(col: Column | str, dtype: str = "timestamp_ntz") -> Column:
    """UTC wall clock of a raw timestamp, independent of the session zone."""
    col = _to_column(col)
    if dtype == "timestamp_ntz":
        return col
    if dtype == "timestamp":
        return _from_epoch("MICROSECOND", F.unix_micros(col))
    if dtype == "string":
        # What follows the time of day is a zone; the cast knows offsets and
        # region names and fails on a zone that it does not know.
        text = F.trim(col)
        zoned = text.rlike(_ZONED)
        instant = F.unix_micros(text.cast("timestamp"))
        return F.when(zoned, _from_epoch("MICROSECOND", instant)).otherwise(
            text.cast("timestamp_ntz")
        )
    return col.cast("timestamp_ntz")


def shift_hours(col: Column | str, hours: int | Column) -> Column:
    col = _to_column(col)
    if isinstance(hours, int):
        return F.timestamp_add("HOUR", F.lit(hours), col) if hours else col
    return F.timestamp_add("HOUR", hours, col)


def add_interval(col: Column | str, amount: int | Column, unit: str) -> Column:
    amount = F.lit(amount) if isinstance(amount, int) else amount
    return F.timestamp_add(unit.upper(), amount, _to_column(col))


def from_epoch_ms(col: Column | str) -> Column:
    return _from_epoch("MILLISECOND", _to_column(col).cast("bigint"))


def day_of(col: Column | str) -> Column:
    return F.to_date(_to_column(col))


def cast_leaf(col: Column | str, dtype: str, source: str = "string", safe: bool = False) -> Column:
    """Cast a nested field; fractional input rounds half away from zero."""
    col = _to_column(col)
    target = LEAF_TYPES.get(dtype, dtype)
    if target == "bigint" and (source in ("double", "float") or source.startswith("decimal")):
        col = F.round(col)
    return col.try_cast(target) if safe else col.cast(target)
