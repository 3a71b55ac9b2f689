"""Masking rules by sensitivity level."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mask(value: Column, sensitivity: str) -> Column:
    """High is removed, Medium becomes a stable pseudonym that still joins, Low is kept."""
    if sensitivity == "High":
        return F.lit(None).cast("string")
    if sensitivity == "Medium":
        return F.sha2(value.cast("string"), 256)
    return value


def mask_pii(df: DataFrame, sensitivity: Mapping[str, str]) -> DataFrame:
    """Masks top-level and dotted (struct field) columns; columns not listed stay as they are."""
    out = df
    for name, level in sensitivity.items():
        if "." in name:
            parent, leaf = name.split(".", 1)
            if parent in df.columns:
                fields = df.schema[parent].dataType.fieldNames()
                if leaf in fields:
                    masked = mask(F.col(name), level)
                    if level == "High":
                        masked = F.lit(None).cast(df.schema[parent].dataType[leaf].dataType)
                    out = out.withColumn(
                        parent,
                        F.when(F.col(parent).isNotNull(), F.col(parent).withField(leaf, masked)),
                    )
        elif name in df.columns:
            masked = mask(F.col(name), level)
            if level == "High":
                masked = F.lit(None).cast(df.schema[name].dataType)
            out = out.withColumn(name, masked)
    return out
