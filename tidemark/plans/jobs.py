"""The whole lake: raw to typed, typed to marts, and the scorecard over the typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import PII_COLUMNS, Config
from tidemark.functions import masks
from tidemark.operators import thresholds, velocity
from tidemark.plans import enriched, gold, scd2, scorecard, silver
from tidemark.streaming.ingest import ingest_all
from tidemark.streaming.refine import LOAD, latest_rows, read_silver, refine, silver_path

CUSTOMER_ATTRS = ("full_name", "dob", "signup_date", "segment", "risk_band", "address", "kyc_status")

# Table names of the reporting layer.
GOLD_TABLES = (
    "dim_customer", "dim_merchant", "dim_date", "fact_transactions", "daily_fraud_summary",
    "customer_risk_scorecard", "merchant_performance_daily", "channel_volume_trends",
)


def gold_path(cfg: Config, name: str) -> str:
    return cfg.table_path("gold", name)


def history_path(cfg: Config) -> str:
    return cfg.table_path("gold", "customer_history")


def build_history(spark: SparkSession, cfg: Config) -> None:
    """Drains new loads of customers into their history, which reads and writes only the buckets of their keys."""
    place = silver_path(cfg, "customers")
    loads = spark.readStream.schema(spark.read.parquet(place).schema).parquet(place).drop(LOAD)
    merge = scd2.merge_batch(history_path(cfg), "customer_id", CUSTOMER_ATTRS, "last_updated_ts", "_ingested_at")
    (loads.writeStream.foreachBatch(merge).trigger(availableNow=True)
     .option("checkpointLocation", f"{cfg.lake_root}/checkpoints/customer_history").start().awaitTermination())


def current_customers(spark: SparkSession, cfg: Config) -> DataFrame:
    """One row per customer, the last by the time of its update: what all tables know about a customer."""
    return gold.dim_customer(scd2.current_version(spark, history_path(cfg)))


def build_silver(spark: SparkSession, cfg: Config) -> list[str | None] | None:
    """Types what is new and brings the enriched transactions up to date; returns the months written again, None for all."""
    for spec in cfg.specs:
        refine(spark, spec, cfg)
    build_history(spark, cfg)
    return enriched.refresh(
        read_silver(spark, cfg, "transactions"),
        current_customers(spark, cfg),
        latest_rows(read_silver(spark, cfg, "merchants"), "merchant_id"),
        silver_path(cfg, "transactions_enriched"), f"{cfg.lake_root}/checkpoints/transactions_enriched", LOAD)


def build_flags(spark: SparkSession, cfg: Config) -> None:
    """Sessions with travel, accuracy and customer flags, by day; customers with the signup flag.

    Travel is judged within a customer: sessions without one are kept and never anomalous.
    """
    customers = current_customers(spark, cfg)
    logs = read_silver(spark, cfg, "device_session_logs").withColumns(
        {"_lat": F.col("geo.lat"), "_long": F.col("geo.long"), "_accuracy": F.col("geo.accuracy_m")})
    unknown = F.col("customer_id").isNull()
    place = ("customer_id", "event_timestamp", "session_id", "_lat", "_long", "_accuracy")
    known = velocity.flag_geo(logs.where(~unknown), *place)
    alone = velocity.without_travel(logs.where(unknown), "_accuracy")
    flagged = known.unionByName(alone).drop("_lat", "_long", "_accuracy")
    (silver.enrich_sessions(flagged, customers).withColumn("event_date", F.to_date("event_timestamp"))
     .hint("rebalance", "event_date").write.mode("overwrite").partitionBy("event_date")
     .parquet(silver_path(cfg, "device_session_logs_enriched")))
    suspects = silver.flag_signup_suspect(customers, read_silver(spark, cfg, "transactions"))
    suspects.write.mode("overwrite").parquet(silver_path(cfg, "customers_flagged"))


def check_thresholds(spark: SparkSession, cfg: Config, tolerance: float = 1.0) -> DataFrame:
    """The watched rates of the flagged tables against their baselines."""
    def rates(df: DataFrame, flags: dict[str, str]) -> DataFrame:
        share = [F.round(F.avg(F.col(flag).cast("int")) * 100, 4).alias(metric) for metric, flag in flags.items()]
        return df.agg(*share).unpivot([], list(flags), "metric", "observed")
    txns = rates(read_silver(spark, cfg, "transactions_enriched"), {
        "pre_signup_rate_pct": "is_signup_date_suspect", "amount_outlier_rate_pct": "is_amount_outlier",
        "orphan_rate_pct": "is_orphan_customer"})
    logs = rates(read_silver(spark, cfg, "device_session_logs_enriched"), {"geo_velocity_anomaly_rate_pct": "is_geo_velocity_anomaly"})
    return thresholds.threshold_check(txns.unionByName(logs), tolerance=tolerance)


def masked(spark: SparkSession, cfg: Config, dataset: str) -> DataFrame:
    """The typed table of a dataset with its personal columns masked by sensitivity."""
    levels = {column: level for name, column, level in PII_COLUMNS if name == dataset}
    return masks.mask_pii(read_silver(spark, cfg, dataset), levels)


def build_gold(spark: SparkSession, cfg: Config) -> None:
    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(gold_path(cfg, name))
        return spark.read.parquet(gold_path(cfg, name))

    customers = save(current_customers(spark, cfg), "dim_customer")
    merchants = latest_rows(read_silver(spark, cfg, "merchants"), "merchant_id")
    save(gold.dim_merchant(merchants), "dim_merchant")
    fact = save(gold.fact_transactions(read_silver(spark, cfg, "transactions_enriched")), "fact_transactions")
    save(gold.dim_date(fact, "txn_date"), "dim_date")
    save(gold.daily_fraud_summary(fact), "daily_fraud_summary")
    save(gold.customer_risk_scorecard(customers, fact), "customer_risk_scorecard")
    save(gold.merchant_performance_daily(fact), "merchant_performance_daily")
    save(gold.channel_volume_trends(fact), "channel_volume_trends")


def check_quality(spark: SparkSession, cfg: Config, today: Column) -> DataFrame:
    """The scorecard over the typed tables."""
    tables = {name: read_silver(spark, cfg, name) for name in ("transactions", "device_session_logs")}
    tables["customers"] = current_customers(spark, cfg)
    tables["merchants"] = latest_rows(read_silver(spark, cfg, "merchants"), "merchant_id")
    return scorecard.scorecard(tables, today)


def run(spark: SparkSession, cfg: Config, run_id: str | None = None) -> DataFrame:
    """Ingests, refines and reports; returns the ingestion status."""
    status = ingest_all(spark, cfg, run_id)
    build_silver(spark, cfg)
    build_flags(spark, cfg)
    build_gold(spark, cfg)
    return status
