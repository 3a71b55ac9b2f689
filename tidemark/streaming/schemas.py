"""Schemas that are settled once per table and remembered beside its checkpoint."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.config import IngestSpec
from tidemark.sources.landing import read_landing_csv, read_landing_json


def load_schema(spark: SparkSession, path: str) -> T.StructType | None:
    try:
        row = spark.read.option("wholetext", True).text(path).first()
    except AnalysisException:
        return None
    return T.StructType.fromJson(json.loads(row[0])) if row else None


def load_or_create_schema(spark: SparkSession, spec: IngestSpec, path: str) -> T.StructType:
    """The remembered schema, else the declared one, else one inferred from what has landed."""
    known = load_schema(spark, path)
    if known is not None:
        return known
    schema = spec.schema
    if schema is None:
        read = read_landing_csv if spec.fmt == "csv" else read_landing_json
        schema = read(spark, spec.source).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return schema
