"""Foreign-key checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import ForeignKey
from tidemark.functions.casts import percent


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.where(F.col(child_key).isNotNull()).join(
        parents, F.col(child_key) == F.col("_parent_key"), "left_anti")


def integrity_check(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, label: str) -> DataFrame:
    """(check_name, non_null_rows, orphan_rows, orphan_pct, status); null keys are not orphans.

    The child is counted per key before it moves, so a key that fills a third of the table still
    travels as one row per task. Null is counted as a key too and left out afterwards: with the same
    counts as every other check of that key, Spark makes them once.
    """
    keys = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_known", F.lit(True))
    given = F.col("_key").isNotNull()
    counted = keys.join(parents, "_key", "left").agg(
        F.coalesce(F.sum(F.when(given, F.col("n"))), F.lit(0)).alias("non_null_rows"),
        F.coalesce(F.sum(F.when(given & F.col("_known").isNull(), F.col("n"))), F.lit(0)).alias("orphan_rows"),
    )
    return counted.select(
        F.lit(label).alias("check_name"), "non_null_rows", "orphan_rows",
        percent(F.col("orphan_rows"), F.col("non_null_rows"), 4).alias("orphan_pct"),
        F.when(F.col("orphan_rows") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def integrity_checks(tables: Mapping[str, DataFrame], foreign_keys: Iterable[ForeignKey]) -> DataFrame:
    """All registered relations in one result."""
    return reduce(DataFrame.unionByName, [
        integrity_check(tables[fk.child], fk.child_key, tables[fk.parent], fk.parent_key, fk.label)
        for fk in foreign_keys
    ])
