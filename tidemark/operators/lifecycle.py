"""Child rows dated before their parent's lifecycle date, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import bucketize
from tidemark.functions.casts import count_when, percent

GAP_EDGES = (1, 7, 30, 365)
GAP_LABELS = ("0-1 days", "2-7 days", "8-30 days", "31-365 days", "over 365 days")


def pre_lifecycle(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    child_date: Column,
    parent_date: Column,
    child_cols: Sequence[str] = (),
    parent_cols: Sequence[str] = (),
) -> DataFrame:
    """Child rows dated before the parent's date: key, both dates, days_before, extra columns.

    Both sides are narrowed first. Spark splits a heavy key on the child side at run time; the
    parent has one row per key.
    """
    return (
        child.select(key, child_date.alias("child_date"), *child_cols)
        .join(parent.select(key, parent_date.alias("parent_date"), *parent_cols), key)
        .where(F.col("child_date") < F.col("parent_date"))
        .withColumn("days_before", F.datediff("parent_date", "child_date"))
    )


def affected_summary(detail: DataFrame, key: str) -> DataFrame:
    return detail.agg(F.count(F.lit(1)).alias("affected_rows"), F.count_distinct(key).alias("affected_keys"))


def concentration(detail: DataFrame, attr: str, key: str, base: DataFrame | None = None) -> DataFrame:
    """(attr, affected_keys, affected_rows[, total_keys, affected_pct]) per attribute value."""
    hit = detail.groupBy(attr).agg(
        F.count_distinct(key).alias("affected_keys"), F.count(F.lit(1)).alias("affected_rows"))
    if base is None:
        return hit
    totals = base.groupBy(attr).agg(F.count(F.lit(1)).alias("total_keys"))
    return hit.join(totals, attr, "left").withColumn(
        "affected_pct", F.round(F.col("affected_keys") / F.col("total_keys") * 100, 2))


def gap_stats(detail: DataFrame, days: str = "days_before") -> DataFrame:
    """One row: min, max, mean, median, p95, p99 and three cumulative counts.

    Everything comes from the histogram of whole days, whose width is the span of the data in days.
    """
    upto = Window.orderBy(days).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = (
        detail.groupBy(days).agg(F.count(F.lit(1)).alias("n"))
        .withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(Window.partitionBy())})
    )

    def at(p: str) -> Column:
        rank = F.ceil(F.lit(p).cast("decimal(9,6)") * F.col("total").cast("decimal(20,0)"))
        return F.max(F.when((rank > F.col("upto") - F.col("n")) & (rank <= F.col("upto")), F.col(days)))

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    d = F.col(days)
    return hist.agg(
        F.min(d).alias("min_days"),
        F.max(d).alias("max_days"),
        F.round(F.sum(d * F.col("n")) / F.sum("n"), 1).alias("mean_days"),
        at("0.5").alias("median_days"),
        at("0.95").alias("p95_days"),
        at("0.99").alias("p99_days"),
        rows(d <= 1).alias("within_1_day"),
        rows(d <= 7).alias("within_7_days"),
        rows(d > 365).alias("over_1_year"),
    )


def gap_buckets(detail: DataFrame, days: str = "days_before") -> DataFrame:
    return detail.groupBy(bucketize(days, GAP_EDGES, GAP_LABELS).alias("gap_bucket")).agg(
        F.count(F.lit(1)).alias("n"))


def overwrite_check(parent: DataFrame, firsts: DataFrame, key: str, lifecycle: Column, updated: Column) -> DataFrame:
    """Parents whose first child precedes their lifecycle date, and whether they changed after it."""
    return (
        parent.select(key, lifecycle.alias("lifecycle_date"), updated.cast("date").alias("updated_date"))
        .join(firsts, key)
        .where(F.col("first_day") < F.col("lifecycle_date"))
        .withColumns({
            "updated_after": F.col("updated_date") > F.col("lifecycle_date"),
            "days_after": F.datediff("updated_date", "lifecycle_date"),
        })
    )


def overwrite_stats(checked: DataFrame) -> DataFrame:
    """One row: affected parents, those updated after the lifecycle date, their mean delay in days."""
    after = F.col("updated_after")
    return checked.agg(
        F.count(F.lit(1)).alias("affected"),
        count_when(after).alias("updated_after"),
        F.round(F.avg(F.when(after, F.col("days_after"))), 1).alias("mean_days_after"),
    ).withColumn("updated_pct", percent(F.col("updated_after"), F.col("affected"), 1))
