"""Impossible travel between consecutive fixes of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import LOW_ACCURACY_M, MAX_SPEED_KMH
from tidemark.functions.casts import count_when
from tidemark.functions.geo import elapsed_hours, haversine_km
from tidemark.operators.quantiles import quantile
from tidemark.operators.sequence import DEFAULT_POLICY, SkewPolicy, has_heavy_key, with_neighbor
from tidemark.session import scratch_path


def _located(lat: str, lng: str) -> Column:
    return F.col(lat).isNotNull() & F.col(lng).isNotNull()


def _fixes(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """The located rows, by way of an array with one fix or none.

    Spark moves a filter below the projection that works out the coordinates, where each condition
    works them out again. Below an array it can't: they are worked out once per row.
    """
    fix = F.when(_located(lat, lng), F.array(F.struct(F.col(lat).alias(lat), F.col(lng).alias(lng))))
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (lat, lng)]
    return df.select(*rest, F.inline(fix)).select(*[F.col(f"`{c}`") for c in df.columns])


def with_speed(
    df: DataFrame, key: str, ts: str, row_id: str, lat: str, lng: str,
    prev_cols: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Every fix with its predecessor in struct ``prev`` and dist_km, time_hours, speed_kmh.

    The three measures are null for the first fix of a key. Rows are ordered by time, then id; rows
    without coordinates are no fixes and left out.
    """
    order = [ts, row_id]
    heavy = has_heavy_key(df, key, order, policy, _located(lat, lng))
    chained = with_neighbor(_fixes(df, lat, lng), key, order, [ts, lat, lng, *prev_cols], "prev", policy=policy, heavy=heavy)
    measured = chained.withColumn(
        "dist_km", haversine_km(F.col(f"prev.{lat}"), F.col(f"prev.{lng}"), F.col(lat), F.col(lng)),
    ).withColumn(
        "time_hours", F.when(F.col("prev").isNotNull(), elapsed_hours(F.col(ts), F.col(f"prev.{ts}"))))
    return measured.withColumn("speed_kmh", F.round(F.col("dist_km") / F.col("time_hours"), 2))


def velocity_pairs(
    df: DataFrame, key: str, ts: str, row_id: str, lat: str, lng: str,
    prev_cols: Sequence[str] = (), policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Consecutive pairs of located rows; rows without coordinates are skipped first."""
    return with_speed(df, key, ts, row_id, lat, lng, prev_cols, policy).where(F.col("prev").isNotNull())


def impossible(pairs: DataFrame, max_kmh: float = MAX_SPEED_KMH) -> DataFrame:
    return pairs.where(F.col("speed_kmh") > max_kmh)


def accuracy_stats(pairs: DataFrame, accuracy: str = "accuracy_m") -> DataFrame:
    """One row on positional accuracy, with the number of pairs that carry none; the median is exact.

    The accuracies are written to the shared folder, so that the passes for the median do not look
    for the pairs again.
    """
    spark, path = pairs.sparkSession, scratch_path(pairs.sparkSession, "accuracy")
    slim = pairs.select(accuracy)
    slim.write.parquet(path)
    pairs, a = spark.read.schema(slim.schema).parquet(path), F.col(accuracy)
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        count_when(a.isNull()).alias("missing"),
        F.min(a).alias("min_m"), F.max(a).alias("max_m"),
        F.round(F.avg(a), 1).alias("mean_m"),
        F.first(quantile(pairs, accuracy, 0.5)).alias("median_m"),
        count_when(a > 1000).alias("over_1km"),
        count_when(a > 5000).alias("over_5km"),
        count_when(a > 10000).alias("over_10km"),
        count_when(a < LOW_ACCURACY_M).alias("reliable"),
    )


def pair_concentration(pairs: DataFrame, dim: str, key: str, k: int | None = None) -> DataFrame:
    """(dim, pairs, distinct_keys), heaviest first; only the first k when k is given."""
    grouped = pairs.groupBy(dim).agg(
        F.count(F.lit(1)).alias("pairs"), F.count_distinct(key).alias("distinct_keys"))
    return grouped.orderBy(F.desc("pairs"), F.asc(dim)).limit(k) if k else grouped


def flag_geo(
    df: DataFrame, key: str, ts: str, row_id: str, lat: str, lng: str, accuracy: str,
    max_kmh: float = MAX_SPEED_KMH, low_accuracy_m: float = LOW_ACCURACY_M,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """All rows with three flags. Rows without coordinates are kept and never anomalous."""
    timed = with_speed(df, key, ts, row_id, lat, lng, policy=policy).drop(
        "prev", "dist_km", "time_hours")
    return _flags(timed, max_kmh, low_accuracy_m, accuracy).unionByName(
        without_travel(df.where(~_located(lat, lng)), accuracy, max_kmh, low_accuracy_m))


def without_travel(df: DataFrame, accuracy: str, max_kmh: float = MAX_SPEED_KMH, low_accuracy_m: float = LOW_ACCURACY_M) -> DataFrame:
    """Rows that cannot be compared with another, with the columns of :func:`flag_geo`."""
    return _flags(df.withColumn("speed_kmh", F.lit(None).cast("double")), max_kmh, low_accuracy_m, accuracy)


def _flags(df: DataFrame, max_kmh: float, low_accuracy_m: float, accuracy: str) -> DataFrame:
    return df.withColumns({
        "is_geo_velocity_anomaly": F.coalesce(F.col("speed_kmh") > max_kmh, F.lit(False)),
        "is_geo_low_accuracy": F.coalesce(F.col(accuracy) >= low_accuracy_m, F.lit(False)),
        "is_geo_accuracy_missing": F.col(accuracy).isNull(),
    })
