"""The four payment datasets, derived from the TPC-H-like test tables.

The test tables are clean. Fixed arithmetic on the keys plants the dirt that the checks look for,
so that the same rows are dirty in every engine and at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ForeignKey

# "Today" for every check that needs one; the test data ends shortly before.
TODAY = "2001-06-01"

GEO_FIELDS = {
    "geo": ["lat", "long", "city", "accuracy_m"],
    "device_meta": ["os", "app_version", "device_model"],
}

# Two relations of the raw test tables with a parent that lost every tenth key.
FOREIGN_KEYS = (
    ForeignKey("transactions", "customer_id", "customers", "customer_id"),
    ForeignKey("transactions", "merchant_id", "merchants", "merchant_id"),
    ForeignKey("transactions", "mcc_code", "merchants", "mcc_code"),
    ForeignKey("device_session_logs", "customer_id", "customers", "customer_id"),
    ForeignKey("transactions", "customer_id", "customers_incomplete", "customer_id"),
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "c_name AS full_name",
        "date_add(date'1900-01-01', CAST(c_custkey * 37 % 38000 AS INT)) AS dob",
        "date_add(date'1995-01-01', CAST(c_custkey * 53 % 1500 AS INT)) AS signup_date",
        "c_mktsegment AS segment",
        "CASE WHEN c_acctbal < 0 THEN 'high' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'low' END AS risk_band",
        "concat('street ', c_nationkey) AS address",
        "CASE c_custkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'pending' ELSE 'rejected' END AS kyc_status",
        "CAST(date_add(date'1995-01-01', CAST(c_custkey * 53 % 1500 + c_custkey * 17 % 700 AS INT))"
        " AS TIMESTAMP_NTZ) AS last_updated_ts",
        "c_nationkey AS nation_key",
        "c_acctbal AS balance",
    )


def customers_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).where("customer_id % 10 <> 0")


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS merchant_id",
        "s_name AS merchant_name",
        "s_nationkey AS mcc_code",
        "CASE WHEN s_acctbal < 0 THEN 'debtor' ELSE 'creditor' END AS category",
        "concat('C', s_nationkey % 10) AS country",
        "date_add(date'1994-01-01', CAST(s_suppkey * 11 % 900 AS INT)) AS onboarding_date",
        "s_acctbal / 100 AS merchant_risk_score",
        "s_nationkey AS nation_key",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS transaction_id",
        "o_custkey * 10 + o_orderkey % 3 AS card_id",
        "CASE WHEN o_orderkey % 503 <> 0 THEN o_custkey END AS customer_id",
        "o_orderkey % 10 AS merchant_id",
        "o_orderdate AS txn_timestamp",
        "CASE WHEN o_orderkey % 211 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount",
        "CASE WHEN o_orderkey % 9 = 0 THEN 'EUR' ELSE 'USD' END AS currency",
        "CAST(o_custkey % 25 AS INT) AS mcc_code",
        "o_orderpriority AS channel",
        "CASE WHEN o_orderkey % 20 = 0 THEN 'refund' WHEN o_orderkey % 20 = 1 THEN 'withdrawal'"
        " ELSE 'purchase' END AS txn_type",
        "o_orderstatus AS status",
        "concat('C', o_custkey % 10) AS country",
        "o_orderstatus = 'P' AS is_fraud_flag",
        "CAST(o_orderdate AS DATE) AS txn_date",
    )


def transactions_landed(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Transactions as they land: all text, some of it unparsable. ``extra`` names more columns of the row itself."""
    return transactions(spark, sf_dir).selectExpr(
        "CAST(transaction_id AS STRING) AS transaction_id",
        "CAST(card_id AS STRING) AS card_id",
        "CAST(customer_id AS STRING) AS customer_id",
        "CAST(merchant_id AS STRING) AS merchant_id",
        "CASE WHEN transaction_id % 109 = 0 THEN 'not a time'"
        " ELSE date_format(txn_timestamp, 'yyyy-MM-dd HH:mm:ss') END AS txn_timestamp",
        "CASE WHEN transaction_id % 101 = 0 THEN 'bad'"
        " ELSE CAST(CAST(amount AS DECIMAL(18,2)) AS STRING) END AS amount",
        "currency",
        "CASE WHEN transaction_id % 113 = 0 THEN 'x12' ELSE CAST(mcc_code AS STRING) END AS mcc_code",
        "channel", "txn_type", "status", "country",
        "CASE WHEN transaction_id % 107 = 0 THEN 'maybe' ELSE CAST(is_fraud_flag AS STRING) END AS is_fraud_flag",
        "CASE WHEN transaction_id % 103 = 0 THEN '2001-02-30'"
        " ELSE date_format(txn_timestamp, 'yyyy-MM-dd') END AS txn_date",
        *extra,
    )


def customers_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).selectExpr(
        "CASE WHEN customer_id % 401 <> 0 THEN CAST(customer_id AS STRING) END AS customer_id",
        "full_name",
        "CASE WHEN customer_id % 97 = 0 THEN 'unknown' ELSE CAST(dob AS STRING) END AS dob",
        "CASE WHEN customer_id % 89 = 0 THEN '31/12/1999' ELSE CAST(signup_date AS STRING) END AS signup_date",
        "segment", "risk_band", "address", "kyc_status",
        "date_format(last_updated_ts, 'yyyy-MM-dd HH:mm:ss') AS last_updated_ts",
    )


def merchants_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchants(spark, sf_dir).selectExpr(
        "CAST(merchant_id AS STRING) AS merchant_id",
        "merchant_name",
        "CAST(mcc_code AS STRING) AS mcc_code",
        "category", "country",
        "CAST(onboarding_date AS STRING) AS onboarding_date",
        "CASE WHEN merchant_id % 7 = 0 THEN 'n/a'"
        " ELSE CAST(CAST(merchant_risk_score AS DECIMAL(18,4)) AS STRING) END AS merchant_risk_score",
    )


def device_session_logs(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    """Sessions with the two structs. With ``dirty=False`` every row has full coordinates."""
    k = F.get_json_object("props", "$.k").cast("int")
    base = read(spark, sf_dir, "events").withColumn("k", k)
    lat, lng = "CAST(k AS DOUBLE) * 1.8 - 90", "CAST(k AS DOUBLE) * 3.6 - 180"
    if dirty:
        lat = f"CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN 90.5 ELSE {lat} END"
        lng = f"CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 47 = 0 THEN -200.25 ELSE {lng} END"
    geo = (
        f"named_struct('lat', {lat}, 'long', {lng}, 'city', concat('city_', k % 12),"
        " 'accuracy_m', CASE WHEN day(ts) % 3 = 0 THEN value * 10 END)"
    )
    meta = (
        "named_struct('os', CASE WHEN k % 2 = 0 THEN 'iOS' ELSE 'Android' END,"
        " 'app_version', CASE WHEN ts >= timestamp_ntz'2024-01-05 00:00:00' THEN concat('4.', k % 5) END,"
        " 'device_model', concat('model_', k % 7))"
    )
    if dirty:
        geo = f"CASE WHEN event_id % 53 <> 0 THEN {geo} END"
        meta = f"CASE WHEN event_id % 59 <> 0 THEN {meta} END"
    return base.selectExpr(
        "event_id AS session_id",
        "user_id AS customer_id",
        "concat('dev_', user_id % 40) AS device_id",
        "event_type",
        "ts AS event_timestamp",
        "concat('10.0.', k, '.', event_id % 250) AS ip_address",
        f"{geo} AS geo",
        f"{meta} AS device_meta",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions with a merchant: the large fact table of the test data."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS transaction_id",
        "l_linenumber AS line_no",
        "l_suppkey AS merchant_id",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS amount",
        "CAST(l_shipdate AS DATE) AS txn_date",
        "l_returnflag = 'R' AS is_returned",
    )


def all_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "customers_incomplete": customers_incomplete(spark, sf_dir),
        "merchants": merchants(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "device_session_logs": device_session_logs(spark, sf_dir),
    }
