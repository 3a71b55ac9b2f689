"""Ranges, future dates, daily volume, missing days and ages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import age_years
from tidemark.functions.casts import count_when


def time_ranges(specs: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_name, column_name, min_value, max_value) as text; one aggregate per table.

    ``specs`` lists tables with their date and timestamp columns.
    """
    parts = []
    for table, df, cols in specs:
        ends = df.agg(*[f(c).alias(f"{tag}{i}") for i, c in enumerate(cols) for tag, f in (("lo", F.min), ("hi", F.max))])
        pattern = {c: "yyyy-MM-dd" if t == "date" else "yyyy-MM-dd HH:mm:ss" for c, t in df.select(*cols).dtypes}
        parts.append(ends.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                     F.date_format(f"lo{i}", pattern[c]).alias("min_value"),
                     F.date_format(f"hi{i}", pattern[c]).alias("max_value"))
            for i, c in enumerate(cols)]))))
    return reduce(DataFrame.unionByName, parts)


def future_dated(df: DataFrame, ts: Column | str, today: Column) -> DataFrame:
    """One row: rows dated after ``today``."""
    day = (F.col(ts) if isinstance(ts, str) else ts).cast("date")
    return df.agg(count_when(day > today).alias("future_rows")).withColumn(
        "status", F.when(F.col("future_rows") > 0, "FAIL").otherwise("PASS"))


def daily_volume(df: DataFrame, ts: Column | str, day: str = "day") -> DataFrame:
    col = (F.col(ts) if isinstance(ts, str) else ts).cast("date")
    return df.groupBy(col.alias(day)).agg(F.count(F.lit(1)).alias("n"))


def day_spine(daily: DataFrame, day: str = "day") -> DataFrame:
    """Every day between the first and the last."""
    ends = daily.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.where(F.col("first").isNotNull()).select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias(day))


def gap_days(daily: DataFrame, day: str = "day") -> DataFrame:
    """Days inside the range on which nothing happened."""
    return day_spine(daily, day).join(daily.select(day), day, "left_anti")


def age_sanity(df: DataFrame, birth: Column, today: Column) -> DataFrame:
    """One row: births in the future, ages below 18, ages above 100."""
    age = age_years(birth, today)
    return df.agg(
        count_when(birth > today).alias("future_birth"),
        count_when(age < 18).alias("under_18"),
        count_when(age > 100).alias("over_100"),
    )


def first_seen(df: DataFrame, key: str, day: Column) -> DataFrame:
    return df.groupBy(key).agg(F.min(day).alias("first_day"))
