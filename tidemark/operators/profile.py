"""Row, duplicate and null counts, cast validation, cardinality and fan-out."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import count_when, percent, safe_cast

_MASK_BITS = 62


def _leaves(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """Every column and, for structs, the struct itself followed by its fields."""
    for f in schema.fields:
        name = f"{prefix}`{f.name}`"
        yield name, f.dataType
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, f"{name}.")


def _null_masks(names: Sequence[str]) -> list[Column]:
    """Null flags of all columns packed into as few bigints as possible."""
    masks = []
    for start in range(0, len(names), _MASK_BITS):
        bits = [
            F.when(F.col(name).isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            for i, name in enumerate(names[start:start + _MASK_BITS])
        ]
        total = bits[0]
        for bit in bits[1:]:
            total = total.bitwiseOR(bit)
        masks.append(total)
    return masks


def _hashable(name: str, dtype: T.DataType) -> Column:
    """A hash skips nulls inside arrays and takes no maps: both are compared as JSON that shows nulls."""
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.to_json(F.col(name), {"ignoreNullFields": "false"})
    return F.col(name)


def profile(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """(metric, column_name, value): rows, full-row duplicates, key duplicates, nulls per column.

    One scan. Rows are reduced to their key, null flags and a 128-bit fingerprint before anything
    is shuffled; two rows count as equal when all three agree.
    """
    leaves = list(_leaves(df.schema))
    names = [name for name, _ in leaves]
    scalars = [_hashable(name, dtype) for name, dtype in leaves if not isinstance(dtype, T.StructType)]
    masks = _null_masks(names)
    mask_names = [f"_m{i}" for i in range(len(masks))]
    keys = [f"_k{i}" for i in range(len(pk))]

    reduced = df.select(
        *[F.col(c).alias(k) for c, k in zip(pk, keys)],
        *[m.alias(n) for m, n in zip(masks, mask_names)],
        F.xxhash64(F.lit(1), *scalars).alias("_h1"),
        F.xxhash64(F.lit(2), *scalars).alias("_h2"),
    )
    variants = reduced.groupBy(*keys, *mask_names, "_h1", "_h2").agg(F.count(F.lit(1)).alias("n"))

    top = [(i, f.name) for i, f in enumerate_top(df.schema, names)]
    null_sums = [
        F.sum(F.when(F.col(mask_names[i // _MASK_BITS]).bitwiseAND(F.lit(1 << (i % _MASK_BITS))) != 0,
                     F.col("n")).otherwise(F.lit(0))).alias(f"_null{j}")
        for j, (i, _) in enumerate(top)
    ]
    per_key = variants.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("variants"), *null_sums)
    zero = F.lit(0).cast("bigint")
    totals = per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("rows"),
        F.coalesce(F.sum("n") - F.sum("variants"), zero).alias("full"),
        F.coalesce(F.sum("n") - F.count(F.lit(1)), zero).alias("keyed"),
        *[F.coalesce(F.sum(f"_null{j}"), zero).alias(f"_null{j}") for j in range(len(top))],
    )
    entries = [
        _entry("rows", None, F.col("rows")),
        _entry("full_row_duplicates", None, F.col("full")),
        _entry("key_duplicates", ",".join(pk), F.col("keyed")),
        *[_entry("nulls", name, F.col(f"_null{j}")) for j, (_, name) in enumerate(top)],
    ]
    return totals.select(F.inline(F.array(*entries)))


def enumerate_top(schema: T.StructType, names: Sequence[str]) -> Iterator[tuple[int, T.StructField]]:
    """Position among all leaves of each top-level column."""
    for f in schema.fields:
        yield names.index(f"`{f.name}`"), f


def _entry(metric: str, column: str | None, value: Column) -> Column:
    return F.struct(
        F.lit(metric).alias("metric"),
        F.lit(column).cast("string").alias("column_name"),
        value.cast("bigint").alias("value"),
    )


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls) in one aggregate without a shuffle of rows."""
    cols = list(cols or df.columns)
    counted = df.agg(*[count_when(F.col(c).isNull()).alias(c) for c in cols])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in cols])))


def duplicate_keys(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row per repeated key with the number of rows that carry it."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def validate_casts(df: DataFrame, checks: Sequence[tuple[str, str]], fmts: Mapping[str, str] | None = None) -> DataFrame:
    """(column_name, expected_type, non_null_rows, cast_failures, failure_pct, status).

    A failure is a non-null value that becomes null in the cast. All checks share one aggregate.
    """
    fmts = fmts or {}
    aggs = []
    for i, (name, to) in enumerate(checks):
        present = F.col(name).isNotNull()
        aggs += [
            count_when(present).alias(f"present{i}"),
            count_when(present & safe_cast(name, to, fmts.get(name)).isNull()).alias(f"failed{i}"),
        ]
    rows = [
        F.struct(
            F.lit(name).alias("column_name"), F.lit(to).alias("expected_type"),
            F.col(f"present{i}").alias("non_null_rows"), F.col(f"failed{i}").alias("cast_failures"))
        for i, (name, to) in enumerate(checks)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows))).select(
        "*",
        percent(F.col("cast_failures"), F.col("non_null_rows"), 2).alias("failure_pct"),
        F.when(F.col("cast_failures") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def cardinality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, total_rows, distinct_values, rows_per_value); null counts as one value.

    Every column is counted per value on its own. Distinct counts of several columns in one aggregate
    would move each row once per column, with all columns as its key.
    """
    parts = []
    for c in cols:
        per_value = df.groupBy(F.col(c).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("distinct_values"),
        ).select(F.lit(c).alias("column_name"), "total_rows", "distinct_values"))
    return reduce(DataFrame.unionByName, parts).select(
        "*",
        F.when(F.col("distinct_values") > 0, F.round(F.col("total_rows") / F.col("distinct_values"), 2))
        .otherwise(F.lit(0.0)).alias("rows_per_value"),
    )
