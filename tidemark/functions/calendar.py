"""Dates, ages, buckets and the month a landing path stands for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import as_column

# Layouts a landing path may follow: /2026/07/, txn_year=2026/txn_month=07 or year=2026/month=07,
# and txn_date=2026-07-15.
_MONTH_PATTERNS = (
    r"/(\d{4})/(\d{2})/",
    r"year=(\d{4})/(?:txn_)?month=(\d{2})(?:/|$)",
    r"_date=(\d{4})-(\d{2})-\d{2}(?:/|$)",
)


def partition_month(path: Column | str) -> Column:
    """``yyyy-MM`` from a landing path, null when no known layout matches."""
    path = as_column(path)
    found = [
        F.nullif(
            F.concat_ws("-", F.regexp_extract(path, p, 1), F.regexp_extract(path, p, 2)),
            F.lit("-"),
        )
        for p in _MONTH_PATTERNS
    ]
    return F.coalesce(*found)


def with_calendar(df: DataFrame, ts: str) -> DataFrame:
    """Adds txn_date, txn_year and txn_month derived from a timestamp."""
    return df.withColumns({
        "txn_date": F.to_date(ts),
        "txn_year": F.date_format(ts, "yyyy"),
        "txn_month": F.date_format(ts, "MM"),
    })


def age_years(birth: Column, today: Column) -> Column:
    return F.months_between(today, birth) / 12


def bucketize(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge (inclusive) a value does not exceed; the last label beyond all."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bucketize needs one more label than edges")
    value = as_column(value)
    result = F.when(value.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        result = result.when(value <= edge, F.lit(label))
    return result.otherwise(F.lit(labels[-1]))
