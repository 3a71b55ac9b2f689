"""Inventory of personal data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import PII_COLUMNS

# Sensitivity levels from most to least sensitive.
LEVELS = ("High", "Medium", "Low")


def sensitivity_order(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    ranked = F.when(col == LEVELS[0], 1)
    for i, level in enumerate(LEVELS[1:], start=2):
        ranked = ranked.when(col == level, i)
    return ranked.otherwise(len(LEVELS) + 1)


def pii_inventory(tables: Mapping[str, DataFrame], inventory: Sequence[tuple[str, str, str]] = PII_COLUMNS) -> DataFrame:
    """(table_name, column_name, sensitivity, total_rows, populated_rows) for every listed column.

    One aggregate per table. A listed column that a table lacks is an error, not a silent zero.
    """
    parts = []
    for table in dict.fromkeys(t for t, _, _ in inventory):
        entries = [(c, s) for t, c, s in inventory if t == table]
        counted = tables[table].agg(
            F.count(F.lit(1)).alias("total_rows"),
            *[F.count(F.col(c)).alias(f"c{i}") for i, (c, _) in enumerate(entries)])
        parts.append(counted.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                     F.lit(s).alias("sensitivity"), F.col("total_rows"),
                     F.col(f"c{i}").alias("populated_rows"))
            for i, (c, s) in enumerate(entries)]))))
    return reduce(DataFrame.unionByName, parts).orderBy(
        sensitivity_order("sensitivity"), "table_name", "column_name")


def pii_totals(inventory: DataFrame) -> DataFrame:
    """(sensitivity, tagged_columns, populated_values)."""
    return inventory.groupBy("sensitivity").agg(
        F.count(F.lit(1)).alias("tagged_columns"), F.sum("populated_rows").alias("populated_values"))
