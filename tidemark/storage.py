"""Folders that outlive a query."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def remove(spark: SparkSession, names: Iterable[str]) -> None:
    """Removes directories; those that are gone already don't matter."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        place = jvm.org.apache.hadoop.fs.Path(name)
        place.getFileSystem(conf).delete(place, True)
