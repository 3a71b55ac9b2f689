"""Checks on struct columns: flattening, two levels of nulls, coordinates, drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import count_when


def flatten_structs(df: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replaces each struct by the given fields as top-level columns."""
    flat = [F.col(f"{parent}.{leaf}").alias(leaf) for parent, leaves in fields.items() for leaf in leaves]
    return df.select(*[c for c in df.columns if c not in fields], *flat)


def nested_nulls(df: DataFrame, fields: Mapping[str, Sequence[str]]) -> DataFrame:
    """(field, nulls, status): struct missing, and sub-field missing inside a present struct."""
    counters = {}
    for parent, leaves in fields.items():
        counters[f"{parent}__struct"] = count_when(F.col(parent).isNull())
        for leaf in leaves:
            counters[f"{parent}__{leaf}"] = count_when(
                F.col(parent).isNotNull() & F.col(f"{parent}.{leaf}").isNull())
    counted = df.agg(*[c.alias(n) for n, c in counters.items()])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("field"), F.col(n).alias("nulls")) for n in counters]))).withColumn(
        "status", F.when(F.col("nulls") > 0, "FAIL").otherwise("PASS"))


def geo_range(df: DataFrame, lat: str = "geo.lat", lng: str = "geo.long") -> DataFrame:
    """One row: coordinates outside the globe and the observed extremes."""
    la, lo = F.col(lat), F.col(lng)
    return df.agg(
        count_when((la < -90) | (la > 90)).alias("invalid_lat"),
        count_when((lo < -180) | (lo > 180)).alias("invalid_long"),
        F.min(la).alias("lat_min"), F.max(la).alias("lat_max"),
        F.min(lo).alias("long_min"), F.max(lo).alias("long_max"),
    )


def edge_samples(df: DataFrame, order: Sequence[str], n: int = 100) -> DataFrame:
    """The n oldest and n newest rows, told apart by column ``edge``."""
    known = df.where(F.col(order[0]).isNotNull())
    oldest = known.orderBy(*[F.asc(c) for c in order]).limit(n).withColumn("edge", F.lit("oldest"))
    newest = known.orderBy(*[F.desc(c) for c in order]).limit(n).withColumn("edge", F.lit("newest"))
    return oldest.unionByName(newest)


def schema_drift(df: DataFrame, order: Sequence[str], fields: Sequence[str], n: int = 100) -> DataFrame:
    """(sub_field, null_oldest, null_newest, status): DRIFT where the two null counts differ."""
    edges = edge_samples(df.select(*order, *fields), order, n)
    counted = edges.agg(*[
        count_when((F.col("edge") == edge) & F.col(f).isNull()).alias(f"{edge}{i}")
        for i, f in enumerate(fields) for edge in ("oldest", "newest")
    ])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("sub_field"), F.col(f"oldest{i}").alias("null_oldest"),
                 F.col(f"newest{i}").alias("null_newest"))
        for i, f in enumerate(fields)]))).withColumn(
        "status", F.when(F.col("null_oldest") != F.col("null_newest"), "DRIFT").otherwise("OK"))
