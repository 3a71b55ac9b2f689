"""Helpers shared by the document operators: tables, folds, scratch files."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.storage import remove

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it.

    Where executors have it elsewhere (``--py-files``, an installed wheel), this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column) -> Column:
    """0, 1 or 2; rows of fold 1 are held out. A null id belongs to no fold and trains nothing."""
    return F.crc32(doc_id.cast("string")) % 3


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes scratch tables; whatever was derived from them must have been written."""
    for t in tables:
        remove(t.sparkSession, [t.scratch_path])


def text_key(text: Column) -> Column:
    """128 bits that stand for a whole text; a null text has the key of the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    return [next(n for n in ("_" * k + name for k in range(1, len(taken) + 2)) if n.lower() not in taken) for name in names]


def keep_rows(docs: DataFrame, keepers: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``keepers`` names by ``id`` and ``key``, one of each repeated row.

    ``keepers`` has one row per (id, key) and ``copies``, the number of rows of docs with both.
    """
    names = docs.columns
    own, doc, key, n = fresh(docs, "own", "doc", "key", "n")
    keyed = docs.withColumn(own, text_key(F.col(text_col)))
    right = keepers.select(F.col("id").alias(doc), F.col("key").alias(key), F.col("copies").alias(n))
    kept = keyed.join(right, keyed[id_col].eqNullSafe(right[doc]) & (keyed[own] == right[key]))
    once = kept.where(F.col(n) == 1).select(*names)
    again = kept.where(F.col(n) > 1).dropDuplicates([id_col, own]).select(*names)
    return once.unionByName(again)
