"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import registry  # noqa: E402

HEADLINE = [
    "profile_lineitem", "pk_duplicates", "cast_validation", "cardinality_lineitem",
    "orphan_rate", "orphan_rate_lineitem", "amount_stats", "lineitem_price_quantiles",
    "channel_share", "heavy_share", "daily_volume", "gap_days",
    "nested_nulls", "schema_drift", "amount_outliers", "velocity_pairs",
    "label_rate_by_flag", "pre_lifecycle_rows", "concentration_by_priority", "lifecycle_gap_stats",
    "silver_transactions", "quarantine_transactions", "silver_enriched", "scd2_history",
    "customer_risk_scorecard", "merchant_performance_daily", "scorecard_lines",
    "ingest_status", "scd2_merged",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture for error messages costs more than the small queries themselves.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One throw-away run so that the first query does not pay for the start of the JVM.
    registry.QUERIES["channel_share"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        # The noop sink computes every row and column without moving results to the driver.
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
