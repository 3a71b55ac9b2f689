"""The enriched transactions, kept up to date month by month.

A month is written again when it has new rows, rows whose customer, merchant or merchant code is known
otherwise than before, or rows between the old and the new outlier threshold. So after every refresh
the table is what a full rebuild would give, with one threshold throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import OUTLIER_QUANTILE
from tidemark.operators.quantiles import exact_quantiles
from tidemark.plans.silver import CUSTOMER_FACTS, MERCHANT_FACTS, enrich_transactions
from tidemark.storage import remove

MONTH = "txn_month"
#: What the enrichment takes from each relation: column of the transactions, key, columns.
_RELATIONS = {
    "customers": ("customer_id", "customer_id", ("customer_id", *CUSTOMER_FACTS)),
    "merchants": ("merchant_id", "merchant_id", ("merchant_id", *MERCHANT_FACTS)),
    "codes": ("mcc_code", "mcc_code", ("mcc_code",)),
}


@dataclass(frozen=True)
class State:
    """What the last refresh has read: its version and the threshold it has used."""

    version: int
    threshold: float | None


def last_state(spark: SparkSession, path: str) -> State | None:
    try:
        row = spark.read.parquet(f"{path}/current").first()
    except AnalysisException:
        return None
    return State(row["version"], row["threshold"])


def _month() -> Column:
    return F.date_format("txn_date", "yyyy-MM")


def touched_months(spark: SparkSession, path: str, state: State, threshold: float | None, transactions: DataFrame, load: str,
                   relations: dict[str, DataFrame]) -> list[str | None]:
    """Months with rows that a full rebuild would write otherwise than the last refresh; None stands for rows without a date."""
    before = f"{path}/version={state.version}"
    seen = [r[0] for r in spark.read.parquet(f"{before}/loads").collect()]
    touched = [transactions.where(~F.col(load).isin(seen)).select(_month().alias("m"))]
    for name, (column, key, _) in _RELATIONS.items():
        old, new = spark.read.parquet(f"{before}/{name}"), relations[name]
        changed = new.subtract(old).union(old.subtract(new)).select(F.col(key).alias("_key")).distinct()
        if not changed.isEmpty():
            touched.append(transactions.join(changed, F.col(column) == F.col("_key"), "left_semi").select(_month().alias("m")))
    if threshold != state.threshold:
        amount, ends = F.col("amount").try_cast("double"), (state.threshold, threshold)
        low, high = (None, None) if None in ends else (min(ends), max(ends))
        moved = F.lit(True) if low is None else (amount > low) & (amount <= high)
        touched.append(transactions.where(moved).select(_month().alias("m")))
    # At most one row per month.
    months: set[str | None] = set()
    for part in touched:
        months |= {r[0] for r in part.distinct().collect()}
    return sorted(months, key=lambda m: (m is not None, m))


def refresh(transactions: DataFrame, customers: DataFrame, merchants: DataFrame, table: str, path: str, load: str,
            p: float = OUTLIER_QUANTILE) -> list[str | None] | None:
    """Brings the table at ``table`` up to date and returns the months written again; None if all were.

    ``load`` names the column of ``transactions`` that tells its loads apart, ``path`` the folder that
    remembers what was read. The table is written before the state that says so: a refresh that
    fails in between is done again by the next one.
    """
    spark = transactions.sparkSession
    relations = {"customers": customers, "merchants": merchants, "codes": merchants.where("mcc_code IS NOT NULL")}
    relations = {name: relations[name].select(*columns).distinct() for name, (_, _, columns) in _RELATIONS.items()}
    state = last_state(spark, path)
    found = exact_quantiles(transactions, F.col("amount").try_cast("double"), [p]).first()
    threshold = found["value"] if found else None
    version = state.version + 1 if state else 0
    for name, df in relations.items():
        df.write.mode("overwrite").parquet(f"{path}/version={version}/{name}")
    loads = [r[0] for r in transactions.select(load).distinct().collect()]
    spark.createDataFrame([(x,) for x in loads], "load int").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}/loads")

    months = touched_months(spark, path, state, threshold, transactions, load, relations) if state else None
    if months != []:
        rows = transactions
        if months is not None:
            named = [m for m in months if m is not None]
            rows = rows.where(_month().isin(named) | (_month().isNull() if None in months else F.lit(False)))
        full = enrich_transactions(rows, customers, merchants, F.lit(threshold).cast("double")).withColumn(MONTH, _month())
        # Months become directories; rebalancing splits a month that is too big for one task.
        (full.hint("rebalance", MONTH).write.mode("overwrite")
         .option("partitionOverwriteMode", "static" if months is None else "dynamic").partitionBy(MONTH).parquet(table))
    spark.createDataFrame([(version, threshold)], "version long, threshold double").coalesce(1).write.mode("overwrite").parquet(f"{path}/current")
    if state:
        remove(spark, [f"{path}/version={state.version}"])
    return months
