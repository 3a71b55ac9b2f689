"""Batch reads of landing directories and the writers that produce such directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.calendar import with_calendar


def read_landing_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All CSV files below a directory, every column as text unless a schema says otherwise."""
    reader = spark.read.option("header", True).option("recursiveFileLookup", True)
    if schema is not None:
        # Files whose header differs from the schema are refused rather than read shifted.
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_landing_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All JSON-lines files below a directory or glob."""
    reader = spark.read.option("recursiveFileLookup", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def inline_df(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def write_csv(df: DataFrame, path: str) -> None:
    """A dimension as CSV: one file while it is small, more where one task would hold too much."""
    df.hint("rebalance").write.mode("overwrite").option("header", True).csv(path)


def write_partitioned_csv(df: DataFrame, ts: str, path: str) -> None:
    """Transactions as CSV below txn_year=/txn_month=.

    Rebalancing writes few files per month and still splits a month that is too big for one task.
    """
    (with_calendar(df, ts).hint("rebalance", "txn_year", "txn_month")
     .write.mode("overwrite").option("header", True).partitionBy("txn_year", "txn_month").csv(path))


def write_daily_json(df: DataFrame, ts: str, path: str) -> None:
    """JSON-lines drops below year=/month=/day=, one or more files per day."""
    stamp = F.to_timestamp(ts) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    dated = df.withColumns({
        "year": F.date_format(stamp, "yyyy"), "month": F.date_format(stamp, "MM"),
        "day": F.date_format(stamp, "dd")})
    (dated.hint("rebalance", "year", "month", "day")
     .write.mode("overwrite").partitionBy("year", "month", "day").json(path))
