"""Amount statistics, frequencies, shares, label rates and outliers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import OUTLIER_QUANTILE
from tidemark.functions.casts import count_when
from tidemark.operators.quantiles import exact_quantiles, quantile

MONEY = "decimal(18,2)"
#: For sums over any measure; values beyond it (from 1e24) are left out instead of failing.
_EXACT = "decimal(30,6)"


def money_sum(col: Column | str) -> Column:
    """Exact sum to six places as a double: independent of the order in which tasks finish."""
    col = F.col(col) if isinstance(col, str) else col
    return F.sum(col.try_cast(_EXACT)).cast("double")


def amount_stats(df: DataFrame, col: str, outlier_p: float | None = None) -> DataFrame:
    """One row: non-null count, min, max, mean, sample stddev, negative and zero counts, median.

    With ``outlier_p`` also the number of rows above that quantile, found by the same passes.
    """
    amount = F.col(col).try_cast("double")
    probs = [0.5] if outlier_p is None else [0.5, outlier_p]
    picked = exact_quantiles(df, amount, probs).withColumn("p", F.col("p").cast("double"))
    placed = picked.agg(F.struct(
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("median_amount"),
        F.max(F.when(F.col("p") == probs[-1], F.col("above"))).alias("outlier_rows"))).scalar()
    stats = df.agg(
        F.count(amount).alias("non_null_count"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.round(F.avg(amount), 4).alias("mean_amount"),
        F.round(F.stddev(amount), 4).alias("stddev_amount"),
        count_when(amount < 0).alias("negative_count"),
        count_when(amount == 0).alias("zero_count"),
    ).withColumn("_placed", placed)
    out = stats.withColumn("median_amount", F.col("_placed.median_amount"))
    if outlier_p is not None:
        out = out.withColumn("outlier_rows", F.coalesce(F.col("_placed.outlier_rows"), F.lit(0)))
    return out.drop("_placed")


def breakdown(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    """(col, n, pct): row count and share of the total per value."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # The total is summed from the same counts, so Spark reuses their shuffle and scans once.
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(F.col("n") / total * 100, scale))


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(col)).limit(k)


def rate_vs_target(df: DataFrame, label: Column, target: float) -> DataFrame:
    """One row: share of true labels beside the rate they were meant to have."""
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(label.cast("int")), 6).alias("actual_rate"),
    ).withColumn("target_rate", F.lit(target))


def dirty_counts(df: DataFrame, key: str, amount: str) -> DataFrame:
    """One row: rows without a key, rows with a negative amount."""
    return df.agg(
        count_when(F.col(key).isNull()).alias("null_key_rows"),
        count_when(F.col(amount) < 0).alias("negative_amount_rows"),
    )


def heavy_share(df: DataFrame, key: str, top: float = 0.2) -> DataFrame:
    """One row: share of all rows that belongs to the heaviest ``top`` of the keys.

    Keys are ranked through the histogram of their row counts. Distinct counts number at most
    sqrt(2 * rows), so the ordered part is small however many keys there are.
    """
    per_key = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    by_count = per_key.groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    totals = by_count.agg(F.struct(
        F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"), F.sum(F.col("n") * F.col("keys")).alias("rows"))).scalar()
    wanted = F.greatest(F.lit(1), F.floor(totals["keys"] * F.lit(top).cast("decimal(9,6)"))).cast("bigint")
    before = F.coalesce(F.sum("keys").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = by_count.withColumn("taken", F.least(F.col("keys"), F.greatest(wanted - before, F.lit(0))) * F.col("n"))
    return ranked.agg(F.coalesce(F.sum("taken"), F.lit(0)).alias("heavy_rows")).select(
        totals["keys"].alias("all_keys"), wanted.alias("heavy_keys"), totals["rows"].alias("all_rows"), "heavy_rows",
        F.round(F.col("heavy_rows") / totals["rows"], 6).alias("heavy_share"),
    )


def amount_outliers(df: DataFrame, col: str, p: float = OUTLIER_QUANTILE) -> DataFrame:
    """Rows strictly above the p-quantile of ``col``. The threshold never leaves the cluster."""
    amount = F.col(col).try_cast("double")
    return df.where(amount > quantile(df, amount, p))


def flag_outliers(df: DataFrame, col: str, p: float = OUTLIER_QUANTILE) -> DataFrame:
    """Adds is_amount_outlier; no row is removed."""
    amount = F.col(col).try_cast("double")
    return df.withColumn("is_amount_outlier", F.coalesce(amount > quantile(df, amount, p), F.lit(False)))


def round_amounts(outliers: DataFrame, col: str) -> DataFrame:
    """One row: rows, amounts divisible by 1000, amounts divisible by 100 but not by 1000."""
    cents = F.round(F.col(col).try_cast(_EXACT), 2)
    return outliers.agg(
        F.count(F.lit(1)).alias("n"),
        count_when(cents % 1000 == 0).alias("round_1000"),
        count_when((cents % 100 == 0) & (cents % 1000 != 0)).alias("round_100"),
    )


def outlier_breakdown(outliers: DataFrame, dim: str, col: str) -> DataFrame:
    """(dim, n, min_amount, max_amount, avg_amount) per value of one dimension."""
    return outliers.groupBy(dim).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.min(col), 2).alias("min_amount"),
        F.round(F.max(col), 2).alias("max_amount"),
        F.round(money_sum(col) / F.count(F.col(col).try_cast(_EXACT)), 2).alias("avg_amount"),
    )


def label_rate_by_flag(facts: DataFrame, key: str, label: Column, flagged: DataFrame) -> DataFrame:
    """(flagged, total_rows, labelled_rows, rate_pct): keys of ``flagged`` against all others.

    Rows without a key belong to the others. Facts are counted per key before the join.
    """
    per_key = facts.groupBy(F.col(key).alias("_key")).agg(
        F.count(F.lit(1)).alias("n"), count_when(label).alias("hits"))
    keys = flagged.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))
    return (
        per_key.join(keys, "_key", "left")
        .groupBy(F.coalesce("_hit", F.lit(False)).alias("flagged"))
        .agg(F.sum("n").alias("total_rows"), F.sum("hits").alias("labelled_rows"))
        .withColumn("rate_pct", F.round(F.col("labelled_rows") / F.col("total_rows") * 100, 4))
    )
