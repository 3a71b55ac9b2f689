"""Observed rates against their baselines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import DQ_THRESHOLDS

# How a metric may leave its baseline: not at all, not upwards, or not in either direction.
RULES = {
    "orphan_rate_pct": "hard",
    "geo_velocity_anomaly_rate_pct": "increase",
    "amount_outlier_rate_pct": "increase",
    "pre_signup_rate_pct": "move",
}


def value_status(value: Column, threshold: float = 0, fail: str = "FAIL") -> Column:
    """``fail`` above the threshold, PASS otherwise, N/A where the value is missing or not a number."""
    number = value.try_cast("double")
    return (F.when(number.isNull() | F.isnan(number), F.lit("N/A"))
            .when(number > threshold, F.lit(fail)).otherwise(F.lit("PASS")))


def threshold_check(
    observed: DataFrame, baselines: Mapping[str, float] = DQ_THRESHOLDS, tolerance: float = 1.0,
) -> DataFrame:
    """(metric, observed, baseline, tolerance, status) for rows (metric, observed)."""
    def lookup(values: Mapping[str, object]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("metric")]

    delta = F.col("observed") - F.col("baseline")
    return observed.withColumns({
        "baseline": lookup({m: float(b) for m, b in baselines.items()}),
        "tolerance": F.lit(float(tolerance)),
        "_rule": lookup(RULES),
    }).withColumn(
        "status",
        F.when(F.col("observed").isNull() | F.col("baseline").isNull(), "N/A")
        .when((F.col("_rule") == "hard") & (delta > 0), "FAIL")
        .when((F.col("_rule") == "increase") & (delta > F.col("tolerance")), "ALERT")
        .when((F.col("_rule") == "move") & (F.abs(delta) > F.col("tolerance")), "ALERT")
        .otherwise("OK"),
    ).drop("_rule")
