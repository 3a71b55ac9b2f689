"""One key with a third of all rows: results stay whole and the work is split."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import distribution, integrity, lifecycle
from tidemark.plans import silver

N = 60_000


@pytest.fixture
def small_limits(spark):
    """Run-time thresholds small enough for this data, and no broadcast joins."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def child(spark):
    return spark.range(0, N, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("d"),
        "id")


def parent(spark):
    return spark.range(5000).select(F.col("id").alias("k"), F.lit("2024-02-01").cast("date").alias("since"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lifecycle_join_splits_the_heavy_key(spark, small_limits):
    detail = lifecycle.pre_lifecycle(child(spark), parent(spark), "k", F.col("d"), F.col("since"), ["id"])
    rows = detail.collect()
    assert "skew=true" in final_plan(detail).replace(" ", "").lower().replace("isskew", "skew")
    assert len(rows) == child(spark).where("d < date'2024-02-01'").count()
    assert len({r.id for r in rows}) == len(rows)


def test_integrity_moves_counts_not_rows(spark, small_limits):
    parents = parent(spark).where("k <> 7")
    check = integrity.integrity_check(child(spark), "k", parents, "k", "c")
    row = check.first()
    assert (row.non_null_rows, row.orphan_rows) == (N, child(spark).where("k = 7").count())
    plan = final_plan(check)
    assert "partial_count(1)" in plan and plan.index("partial_count(1)") > plan.index("Exchange hashpartitioning")


def test_label_rate_with_heavy_key(spark, small_limits):
    facts = child(spark).withColumn("y", F.col("id") % 2 == 0)
    flagged = parent(spark).where("k = 7").select("k")
    got = {r.flagged: (r.total_rows, r.labelled_rows)
           for r in distribution.label_rate_by_flag(facts, "k", F.col("y"), flagged).collect()}
    hot = facts.where("k = 7")
    assert got[True] == (hot.count(), hot.where("y").count())
    assert got[True][0] + got[False][0] == N


def test_enrichment_with_heavy_and_missing_keys(spark, small_limits):
    """A third of the transactions has no customer, another third has one and the same."""
    txns = spark.range(0, N, 1, 8).select(
        F.col("id").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") % 5000).alias("customer_id"),
        (F.col("id") % 50).alias("merchant_id"), (F.col("id") % 4).cast("int").alias("mcc_code"),
        F.col("id").cast("double").alias("amount"), F.lit("2024-01-15").cast("date").alias("txn_date"))
    customers = parent(spark).select(
        F.col("k").alias("customer_id"), F.lit("s").alias("segment"), F.lit("r").alias("risk_band"),
        F.lit("v").alias("kyc_status"), F.col("since").alias("signup_date"))
    merchants = spark.range(50).select(
        F.col("id").alias("merchant_id"), F.lit("m").alias("merchant_name"), (F.col("id") % 2).cast("int").alias("mcc_code"),
        F.lit("c").alias("category"), F.lit(1.0).alias("merchant_risk_score"))
    row = silver.enrich_transactions(txns, customers, merchants).agg(
        F.count("*").alias("n"), F.count_distinct("transaction_id").alias("ids"),
        F.count_if("is_amount_outlier").alias("outliers"), F.count_if("is_signup_date_suspect").alias("early"),
        F.count_if("is_unknown_mcc").alias("mcc"), F.count("segment").alias("known")).first()
    assert (row.n, row.ids) == (N, N)
    assert row.outliers == N - 59940
    assert row.early == row.known == 2 * N // 3
    assert row.mcc == N // 2
