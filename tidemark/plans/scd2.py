"""Slowly changing dimensions: one row per version of a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.sequence import DEFAULT_POLICY, SkewPolicy, has_heavy_key, with_neighbor
from tidemark.storage import remove


def scd2(
    changes: DataFrame, key: str, attrs: Sequence[str], ts: str, tie: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """key, attrs, valid_from, valid_to, is_current from a log of observed attribute values.

    Observations that repeat the previous values open no version. Of several observations with
    one timestamp the one with the highest ``tie`` counts.
    """
    state = F.struct(*attrs)
    latest = changes.groupBy(key, ts).agg(
        F.max(F.struct(F.col(tie) if tie else F.lit(0), state)).alias("_last"))
    observed = latest.select(key, F.col(ts).alias("valid_from"), *[F.col(f"_last.col2.{a}").alias(a) for a in attrs])

    # Heavy keys are looked for once, in the raw log; both neighbour steps share the answer.
    heavy = has_heavy_key(changes, key, [ts], policy)
    chained = with_neighbor(observed, key, ["valid_from"], attrs, "_prev", policy=policy, heavy=heavy)
    changed: list[Column] = [~F.col(a).eqNullSafe(F.col(f"_prev.{a}")) for a in attrs]
    versions = chained.where(F.col("_prev").isNull() | reduce(Column.__or__, changed)).drop("_prev")
    bounded = with_neighbor(versions, key, ["valid_from"], ["valid_from"], "_next", True, policy, heavy)
    return bounded.select(
        key, *attrs, "valid_from",
        F.col("_next.valid_from").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )


def scd2_merge(
    dim: DataFrame, log: DataFrame, touched: DataFrame, key: str, attrs: Sequence[str], ts: str,
    tie: str | None = None, policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """The dimension after news about the keys of ``touched``; other keys pass through unchanged.

    Touched keys are rebuilt from ``log``, all their observations so far. Versions alone would not
    do: a late row may fall between two repeats of one value, of which the dimension shows one.
    """
    keys = touched.select(F.col(key).alias("_touched")).distinct()
    match = F.col(key).eqNullSafe(F.col("_touched"))
    untouched = dim.join(keys, match, "left_anti")
    return untouched.unionByName(scd2(log.join(keys, match, "left_semi"), key, attrs, ts, tie, policy))


#: Hash buckets of a maintained dimension. Fixed for its lifetime: a batch rewrites only the buckets its keys fall into.
BUCKETS = 256


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _manifest(spark: SparkSession, path: str, version: int, replaced: bool = False) -> dict[int, int]:
    """Bucket -> the version that wrote it last, or which that one has replaced; at most one entry per bucket."""
    rows = spark.read.parquet(f"{path}/manifest/version={version}").where(F.col("replaced") == replaced).collect()
    return {r["bucket"]: r["written"] for r in rows}


def newest_version(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(f"{path}/current").first()["version"]


def read_buckets(spark: SparkSession, path: str, what: str, written: Mapping[int, int]) -> DataFrame:
    """``log`` or ``state`` in the given versions of the given buckets, and of no others."""
    like = spark.read.parquet(f"{path}/schema/{what}")
    files = [f"{path}/{what}/version={v}/bucket={b}" for b, v in sorted(written.items())]
    return spark.read.schema(like.schema).parquet(*files) if files else like


def current_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state written by :func:`merge_batch`."""
    return read_buckets(spark, path, "state", _manifest(spark, path, newest_version(spark, path)))


def merge_batch(path: str, key: str, attrs: Sequence[str], ts: str, tie: str | None = None, buckets: int = BUCKETS):
    """A ``foreachBatch`` function that maintains the dimension below ``path``.

    Observations (the log) and versions (the state) lie in hash buckets of the key. Batch n reads the
    buckets that its keys fall into, writes them anew as version n, writes a manifest that names the
    version of every bucket, and then names n in ``current``: readers see the old state until all is
    written, and a repeated batch changes nothing. What a batch replaces is removed by the next one, so
    that readers of the state before may finish.
    """
    columns = list(dict.fromkeys([key, *attrs, ts, *([tie] if tie else [])]))

    def save(df: DataFrame, what: str, version: int) -> None:
        spark = df.sparkSession
        placed = df.withColumn("bucket", bucket_of(key, buckets))
        # A bucket that one key fills is split over several files.
        placed.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{what}/version={version}")
        if not version:
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/schema/{what}")

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.select(*columns).write.mode("overwrite").parquet(f"{path}/news")
        news = spark.read.parquet(f"{path}/news")
        # At most one number per bucket.
        touched = [r[0] for r in news.select(bucket_of(key, buckets)).distinct().collect()]
        written = _manifest(spark, path, batch_id - 1) if batch_id else {}
        expired = _manifest(spark, path, batch_id - 1, replaced=True) if batch_id else {}
        if touched or not batch_id:
            old = {b: written[b] for b in touched if b in written}
            if old:
                log = read_buckets(spark, path, "log", old).unionByName(news)
                save(log, "log", batch_id)
                fresh = read_buckets(spark, path, "log", dict.fromkeys(touched, batch_id))
                state = scd2_merge(read_buckets(spark, path, "state", old), fresh, news, key, attrs, ts, tie)
            else:
                save(news, "log", batch_id)
                state = scd2(news, key, attrs, ts, tie)
            save(state, "state", batch_id)
        # Replaced by the last batch, so used by states before it only.
        remove(spark, [f"{path}/{what}/version={v}/bucket={b}" for b, v in expired.items() for what in ("log", "state")])
        named = written | dict.fromkeys(touched, batch_id)
        replaced = [(b, written[b], True) for b in touched if b in written]
        rows = [(b, v, False) for b, v in named.items()] + replaced
        spark.createDataFrame(rows, "bucket int, written long, replaced boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={batch_id}")
        spark.createDataFrame([(batch_id,)], "version long").coalesce(1).write.mode("overwrite").parquet(f"{path}/current")
        remove(spark, [f"{path}/manifest/version={batch_id - 2}"] if batch_id > 1 else [])

    return apply
