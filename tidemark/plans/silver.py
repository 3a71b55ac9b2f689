"""Typed and flagged tables with their quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import safe_cast
from tidemark.operators.distribution import MONEY, flag_outliers

# Target types by dataset; columns not named here stay text.
TYPES: dict[str, dict[str, str]] = {
    "customers": {"dob": "date", "signup_date": "date", "last_updated_ts": "timestamp"},
    "merchants": {"mcc_code": "int", "onboarding_date": "date", "merchant_risk_score": "double"},
    "transactions": {"txn_timestamp": "timestamp", "amount": MONEY, "mcc_code": "int",
                     "is_fraud_flag": "boolean", "txn_date": "date"},
    "device_session_logs": {"event_timestamp": "timestamp"},
}

# Keys without which a row cannot be used. A missing foreign key is a fact about the row, not a reason to lose it.
REQUIRED: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "transactions": ("transaction_id",),
    "device_session_logs": ("session_id",),
}


# What transactions take from their customer and merchant.
CUSTOMER_FACTS = ("segment", "risk_band", "kyc_status", "signup_date")
MERCHANT_FACTS = ("merchant_name", "category", "merchant_risk_score")


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts the named columns; unparsable text becomes null. Audit columns ride along."""
    return df.select(*[safe_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def reject_reasons(df: DataFrame, types: Mapping[str, str], required: Sequence[str]) -> Column:
    """Names of failed rules as a list: ``missing_x`` for keys, ``bad_x`` for parse failures."""
    rules = [F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in required]
    rules += [
        F.when(F.col(c).isNotNull() & safe_cast(c, to).isNull(), F.lit(f"bad_{c}"))
        for c, to in types.items() if c in df.columns
    ]
    return F.array_compact(F.array(*rules))


def split_quarantine(df: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected raw rows with ``reject_reasons``); together they are the input.

    Datasets without required columns, such as merchants, reject nothing: what does not parse
    becomes null.
    """
    types, required = TYPES[dataset], REQUIRED.get(dataset)
    if required is None:
        return typed(df, types), df.withColumn("reject_reasons", F.array().cast("array<string>")).where("false")
    marked = df.withColumn("reject_reasons", reject_reasons(df, types, required))
    good = marked.where(F.size("reject_reasons") == 0).drop("reject_reasons")
    return typed(good, types), marked.where(F.size("reject_reasons") > 0)


def typed_with_flags(good: DataFrame, dataset: str) -> DataFrame:
    """Flags that depend on the row alone."""
    if dataset == "transactions":
        return good.withColumns({"is_negative_amount": F.coalesce(F.col("amount") < 0, F.lit(False)),
                                 "is_missing_customer": F.col("customer_id").isNull()})
    return good


def silver_customers(bronze: DataFrame) -> DataFrame:
    return split_quarantine(bronze, "customers")[0]


def silver_merchants(bronze: DataFrame) -> DataFrame:
    return split_quarantine(bronze, "merchants")[0]


def silver_transactions(bronze: DataFrame) -> DataFrame:
    return typed_with_flags(split_quarantine(bronze, "transactions")[0], "transactions")


def silver_device_session_logs(bronze: DataFrame) -> DataFrame:
    return split_quarantine(bronze, "device_session_logs")[0]


def flag_signup_suspect(customers: DataFrame, transactions: DataFrame) -> DataFrame:
    """Customers with is_signup_date_suspect: some transaction precedes the signup date."""
    firsts = transactions.groupBy(F.col("customer_id").alias("_key")).agg(F.min("txn_date").alias("_first"))
    return customers.join(firsts, F.col("customer_id") == F.col("_key"), "left").withColumn(
        "is_signup_date_suspect", F.coalesce(F.col("_first") < F.col("signup_date"), F.lit(False))
    ).drop("_key", "_first")


def enrich_transactions(
    transactions: DataFrame, customers: DataFrame, merchants: DataFrame, threshold: Column | None = None,
) -> DataFrame:
    """Transactions with customer and merchant attributes and all row-level flags; no row is lost.

    ``threshold`` is the amount above which a row is an outlier; by default that of these rows.

    Dimensions are joined without hints: Spark broadcasts them while they are below its size
    limit and falls back to a shuffle join, split where keys are heavy, beyond it. Merchant codes
    repeat among merchants, so that relation only answers whether a code exists.
    """
    c = customers.select(
        F.col("customer_id").alias("_cust"), *CUSTOMER_FACTS)
    m = merchants.select(F.col("merchant_id").alias("_merch"), *MERCHANT_FACTS)
    codes = merchants.select(F.col("mcc_code").alias("_code")).where(F.col("_code").isNotNull()).distinct()
    flagged = flag_outliers(transactions, "amount") if threshold is None else transactions.withColumn(
        "is_amount_outlier", F.coalesce(F.col("amount").try_cast("double") > threshold, F.lit(False)))
    joined = (
        flagged
        .join(c, F.col("customer_id") == F.col("_cust"), "left")
        .join(m, F.col("merchant_id") == F.col("_merch"), "left")
        .join(codes, F.col("mcc_code") == F.col("_code"), "left")
    )
    return joined.withColumns({
        "is_negative_amount": F.coalesce(F.col("amount") < 0, F.lit(False)),
        "is_signup_date_suspect": F.coalesce(F.col("txn_date") < F.col("signup_date"), F.lit(False)),
        "is_missing_customer": F.col("customer_id").isNull(),
        "is_orphan_customer": F.col("customer_id").isNotNull() & F.col("_cust").isNull(),
        "is_orphan_merchant": F.col("merchant_id").isNotNull() & F.col("_merch").isNull(),
        "is_unknown_mcc": F.col("mcc_code").isNotNull() & F.col("_code").isNull(),
    }).drop("_cust", "_merch", "_code")


def enrich_sessions(sessions: DataFrame, customers: DataFrame) -> DataFrame:
    """Sessions with the customer's segment and risk band; unknown customers are flagged."""
    c = customers.select(F.col("customer_id").alias("_cust"), "segment", "risk_band")
    return sessions.join(c, F.col("customer_id") == F.col("_cust"), "left").withColumn(
        "is_orphan_customer", F.col("customer_id").isNotNull() & F.col("_cust").isNull()).drop("_cust")
