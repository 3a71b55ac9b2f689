"""The previous or next row of each key, also where one key holds a large part of the table.

A plain window puts a whole key into one task. Where a key is too heavy for that, rows are dealt by
ranges of (key, order) instead, numbered within their range, and cut by number into cells of the same
size whatever the keys and times are. The window works per cell; the row on the other side of a
cell's edge is carried into it, one row per cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path


@dataclass(frozen=True)
class SkewPolicy:
    """When keys are too heavy for a window of their own, and what replaces it.

    ``heavy_rows``: estimated rows of a key above which rows are dealt by ranges.
    ``sample_every``: one row in so many is hashed into the estimate.
    ``cell_rows``: rows of a cell.
    """

    heavy_rows: int = 4_000_000
    sample_every: int = 1024
    cell_rows: int = 2_000_000


DEFAULT_POLICY = SkewPolicy()


def has_heavy_key(
    df: DataFrame, key: str, order: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY, of: Column | None = None,
) -> bool:
    """Whether a hash sample shows a key with more than ``heavy_rows`` rows. Runs one narrow job.

    ``of`` says which rows count; only rows of the sample are asked.
    """
    sampled = df.where(f"pmod(xxhash64({', '.join([key, *order])}), {policy.sample_every}) = 0")
    if of is not None:
        sampled = sampled.where(of)
    counted = sampled.groupBy(key).agg(F.count(F.lit(1)).alias("seen"))
    return not counted.where(F.col("seen") * policy.sample_every > policy.heavy_rows).isEmpty()


def in_cells(df: DataFrame, key: str, order: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """``df`` with _at, which numbers the rows by (key, order), and _cell, which has at most ``cell_rows`` of them.

    Written to the shared folder: all later steps see the same ranges, also after a retry.
    """
    place = [key, *order]
    # The upper bits of the number name the range; ranges are 2^33 apart, so that no cell reaches into two.
    dealt = df.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "cells")
    dealt.write.parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path).withColumn("_cell", F.expr(f"_at div {policy.cell_rows}L"))


def with_neighbor(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    cols: Sequence[str],
    into: str,
    forward: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
    heavy: bool | None = None,
) -> DataFrame:
    """Adds struct column ``into`` with ``cols`` of the previous (or next) row of the same key.

    ``order`` must be a total order within the key; nulls come first, and rows without a key follow
    each other like those of any key. The struct is null where there is no neighbour. ``heavy`` may
    carry the answer of :func:`has_heavy_key`; it decides how rows are dealt, never the result. With
    heavy keys the rows are written to the shared folder when this is called.
    """
    step = F.lead if forward else F.lag
    payload = F.struct(*cols)
    if not (has_heavy_key(df, key, order, policy) if heavy is None else heavy):
        return df.withColumn(into, step(payload, 1).over(Window.partitionBy(key).orderBy(*order)))

    rows = in_cells(df, key, order, policy)
    seen = F.struct(F.col(key).alias("k"), payload.alias("v"))
    # The row next to the edge goes to the neighbouring cell; there are rows / cell_rows of them.
    at, edge, beyond = (F.min, F.min_by, F.lag) if forward else (F.max, F.max_by, F.lead)
    edges = rows.groupBy("_cell").agg(at("_at").alias("_at"), edge(seen, "_at").alias("_edge"))
    carried = edges.select(
        beyond("_cell", 1).over(Window.orderBy("_cell")).alias("_cell"), "_at", F.lit(True).alias("_carried"),
        F.col("_edge.k").alias(key), *[F.col(f"_edge.v.{c}").alias(c) for c in dict.fromkeys(cols) if c != key],
    ).where("_cell IS NOT NULL")
    full = rows.withColumn("_carried", F.lit(False)).unionByName(carried, allowMissingColumns=True)
    near = full.withColumn("_near", step(seen, 1).over(Window.partitionBy("_cell").orderBy("_at"))).where("NOT _carried")
    return near.withColumn(
        into, F.when(F.col("_near.k").eqNullSafe(F.col(key)), F.col("_near.v"))).drop("_at", "_cell", "_carried", "_near")
