"""Casts that turn unparsable values into null whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def safe_cast(value: Column | str, to: str, fmt: str | None = None) -> Column:
    """Cast a string column; null where the text does not parse."""
    col = as_column(value)
    if to == "date":
        return F.try_to_date(col, fmt or DATE_FORMAT)
    if to == "timestamp":
        return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)
    return col.try_cast(to)


def percent(part: Column, whole: Column, scale: int) -> Column:
    """``part / whole`` in percent; 0, not null, when there is nothing to divide by."""
    return F.when(whole > 0, F.round(part / whole * 100, scale)).otherwise(F.lit(0.0))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))
