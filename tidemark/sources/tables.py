"""Managed tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", partition_by: tuple[str, ...] = (),
    database_path: str | None = None,
) -> None:
    """Saves under ``database.table``; the database is created when absent.

    ``database_path`` places a new database outside the session's warehouse folder.
    """
    spark = df.sparkSession
    if "." in name:
        place = f" LOCATION '{database_path}'" if database_path else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}{place}")
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
