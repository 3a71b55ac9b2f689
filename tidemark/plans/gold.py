"""Dimensions, facts and daily marts. Flags travel as columns; nothing is filtered by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import LABEL_CAVEAT
from tidemark.functions.casts import count_when
from tidemark.operators.distribution import money_sum
from tidemark.operators.timeline import day_spine

FLAGS = (
    "is_fraud_flag", "is_amount_outlier", "is_negative_amount",
    "is_signup_date_suspect", "is_missing_customer", "is_orphan_customer", "is_orphan_merchant", "is_unknown_mcc",
)


def dim_customer(history: DataFrame) -> DataFrame:
    """The current version of every customer."""
    return history.where("is_current").drop("is_current", "valid_to")


def dim_merchant(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant_id", "merchant_name", "mcc_code", "category", "country", "onboarding_date",
                            "merchant_risk_score")


def dim_date(facts: DataFrame, day: str) -> DataFrame:
    """Every day the facts span, with its calendar parts."""
    days = day_spine(facts.select(F.col(day).cast("date").alias("day")), "day")
    d = F.col("day")
    return days.select(
        d.alias("date_day"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("iso_weekday"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )


def fact_transactions(enriched: DataFrame) -> DataFrame:
    """Keys, measures and every flag of the enriched transactions."""
    return enriched.select(
        "transaction_id", "customer_id", "merchant_id", "txn_date", "channel", "status", "currency",
        F.col("amount").cast("decimal(18,2)").alias("amount"),
        (F.col("txn_type") == "refund").alias("is_returned"), *FLAGS)


def daily_fraud_summary(fact: DataFrame) -> DataFrame:
    """Per day: volume and labelled volume, with the caveat on the label."""
    return fact.groupBy("txn_date").agg(
        F.count(F.lit(1)).alias("txns"),
        money_sum("amount").alias("amount"),
        count_when(F.col("is_fraud_flag")).alias("flagged_txns"),
        money_sum(F.when(F.col("is_fraud_flag"), F.col("amount")).otherwise(F.lit(0))).alias("flagged_amount"),
    ).withColumns({
        "flagged_rate": F.round(F.col("flagged_txns") / F.col("txns"), 6),
        "label_caveat": F.lit(LABEL_CAVEAT),
    })


def customer_risk_scorecard(customers: DataFrame, fact: DataFrame) -> DataFrame:
    """Every customer with the volume and flag counts of its transactions.

    Facts are summed per customer before the join, so a dominant customer moves as one row per task.
    """
    per_customer = fact.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("txns"),
        money_sum("amount").alias("amount"),
        count_when(F.col("is_fraud_flag")).alias("flagged_txns"),
        count_when(F.col("is_amount_outlier")).alias("outlier_txns"),
        count_when(F.col("is_signup_date_suspect")).alias("pre_signup_txns"),
    )
    joined = customers.select("customer_id", "segment", "risk_band", "kyc_status").join(
        per_customer, "customer_id", "left")
    return joined.na.fill(0, ["txns", "amount", "flagged_txns", "outlier_txns", "pre_signup_txns"]).withColumn(
        "label_caveat", F.lit(LABEL_CAVEAT))


def merchant_performance_daily(lines: DataFrame) -> DataFrame:
    """Per merchant and day: lines, net amount, returns."""
    return lines.groupBy("merchant_id", "txn_date").agg(
        F.count(F.lit(1)).alias("txns"),
        money_sum("amount").alias("net_amount"),
        count_when(F.col("is_returned")).alias("returned"),
    ).withColumn("return_rate", F.round(F.col("returned") / F.col("txns"), 6))


def channel_volume_trends(fact: DataFrame) -> DataFrame:
    """Per channel and month: volume beside that of the channel's previous month on record."""
    monthly = fact.groupBy("channel", F.date_format("txn_date", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("txns"), money_sum("amount").alias("amount"))
    order = Window.partitionBy("channel").orderBy("month")
    return monthly.withColumn("prev_txns", F.lag("txns").over(order)).withColumn(
        "txn_change", F.col("txns") - F.col("prev_txns"))
