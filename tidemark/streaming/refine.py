"""Incremental typing of raw tables: every raw row goes once to the typed table or to quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Config, IngestSpec
from tidemark.plans.silver import REQUIRED, split_quarantine, typed_with_flags
from tidemark.streaming.ingest import EVENT_DAY, PARTITION_MONTH

LOAD = "_load_id"

# Table names of the refined layer.
SILVER_TABLES = {
    "customers": "silver_customers",
    "merchants": "silver_merchants",
    "transactions": "silver_transactions",
    "device_session_logs": "silver_device_session_logs",
    "transactions_enriched": "silver_transactions_enriched",
    "device_session_logs_enriched": "silver_device_session_logs_enriched",
    "customers_flagged": "silver_customers_flagged",
    "customers_quarantine": "silver_customers_quarantine",
    "transactions_quarantine": "silver_transactions_quarantine",
    "device_session_logs_quarantine": "silver_device_session_logs_quarantine",
}


def silver_path(cfg: Config, name: str) -> str:
    return cfg.table_path("silver", SILVER_TABLES[name])


def read_silver(spark: SparkSession, cfg: Config, name: str) -> DataFrame:
    return spark.read.parquet(silver_path(cfg, name))


def refine(spark: SparkSession, spec: IngestSpec, cfg: Config) -> None:
    """Drains what is new in the raw table of one dataset.

    Typing looks at single rows only, so nothing is shuffled. Each batch overwrites its own
    directory in both targets, hence repeating it changes nothing.
    """
    source = cfg.table_path("bronze", spec.table)
    raw = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)

    def save(df: DataFrame, name: str, batch_id: int) -> None:
        writer = df.write.mode("overwrite")
        parts = [c for c in (PARTITION_MONTH, EVENT_DAY) if c in df.columns]
        if parts:
            # Raw files hold one month or day each, so this adds no small files and needs no shuffle.
            writer = writer.partitionBy(*parts)
        writer.parquet(f"{silver_path(cfg, name)}/{LOAD}={batch_id}")

    def load(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_quarantine(batch, spec.name)
        save(typed_with_flags(good, spec.name), spec.name, batch_id)
        if spec.name in REQUIRED:
            save(bad, f"{spec.name}_quarantine", batch_id)

    (raw.writeStream.foreachBatch(load).trigger(availableNow=True)
     .option("checkpointLocation", f"{cfg.lake_root}/checkpoints/silver_{spec.name}")
     .start().awaitTermination())


def latest_rows(df: DataFrame, key: str) -> DataFrame:
    """One row per key of a table that receives full loads repeatedly: the most recently ingested.

    The rows are compared as one struct, so the choice is the same in every run.
    """
    rest = [c for c in df.columns if c not in (key, "_ingested_at")]
    newest = df.groupBy(key).agg(F.max(F.struct("_ingested_at", *rest)).alias("_row"))
    return newest.select(key, *[F.col(f"_row.{c}").alias(c) for c in df.columns if c != key]).select(*df.columns)
