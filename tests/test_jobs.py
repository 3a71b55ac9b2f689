"""Landing files to marts, twice, with late files in between."""

import json

import pytest
from pyspark.sql import functions as F
from test_ingest import HEADER, SESSION, put

from tidemark.config import Config
from tidemark.plans import jobs, scorecard, silver
from tidemark.streaming.ingest import ingest_all
from tidemark.streaming.refine import latest_rows, read_silver

CUSTOMERS = "customer_id,full_name,dob,signup_date,segment,risk_band,address,kyc_status,last_updated_ts"
MERCHANTS = "merchant_id,merchant_name,mcc_code,category,country,onboarding_date,merchant_risk_score"


def customer(cid, kyc, updated):
    return f"{cid},Name,1990-01-01,2026-01-01,retail,low,Street,{kyc},{updated}"


def line(i, cust, amount, day, ttype="purchase"):
    return f"t{i},k1,{cust},m1,{day} 10:00:00,{amount},USD,5411,POS,{ttype},approved,US,false,{day}"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    cfg = Config("dev", str(root / "landing"), str(root / "lake"))
    land = cfg.landing_root
    put(f"{land}/customers/full_load/a.csv", CUSTOMERS, customer("c1", "pending", "2026-02-01 00:00:00"),
        customer("c2", "verified", "2026-02-01 00:00:00"), customer("", "verified", "2026-02-01 00:00:00"))
    put(f"{land}/merchants/full_load/a.csv", MERCHANTS, "m1,Shop,5411,food,US,2020-01-01,n/a")
    put(f"{land}/transactions/2026/03/a.csv", HEADER, line(1, "c1", "10.00", "2026-03-01"),
        line(2, "c1", "-4.00", "2026-03-01", "refund"), line(3, "", "1.00", "2026-03-01"),
        line(4, "c2", "oops", "2026-03-01"), line(5, "c9", "7.00", "2026-03-03"))
    put(f"{land}/device_session_logs/2026/03/a.json", json.dumps(SESSION), "{broken")
    jobs.run(spark, cfg, "run-1")
    # An older row of c2 arrives late: ingested last, but not the last update.
    put(f"{land}/customers/full_load/b.csv", CUSTOMERS, customer("c1", "verified", "2026-03-05 00:00:00"),
        customer("c2", "rejected", "2025-12-01 00:00:00").replace("2026-01-01", "2026-03-20"))
    put(f"{land}/transactions/2026/04/b.csv", HEADER, line(6, "c2", "20.00", "2026-04-01"))
    jobs.run(spark, cfg, "run-2")
    return cfg


def test_typed_and_rejected_rows_are_all_rows_once(spark, lake):
    good, bad = read_silver(spark, lake, "transactions"), read_silver(spark, lake, "transactions_quarantine")
    assert sorted(r.transaction_id for r in good.collect()) == ["t1", "t2", "t3", "t5", "t6"]
    assert {r.transaction_id: r.reject_reasons for r in bad.collect()} == {
        "t4": ["bad_amount"]}
    assert [r.transaction_id for r in good.where("is_missing_customer").collect()] == ["t3"]
    assert {r._pipeline_run_id for r in good.collect()} == {"run-1", "run-2"}
    broken = read_silver(spark, lake, "device_session_logs_quarantine").first()
    assert broken.reject_reasons == ["missing_session_id"] and "broken" in broken._rescued_data
    assert read_silver(spark, lake, "merchants").first().merchant_risk_score is None


def test_marts_after_two_runs(spark, lake):
    def table(name):
        return spark.read.parquet(jobs.gold_path(lake, name))

    assert {r.customer_id: r.kyc_status for r in table("dim_customer").collect()} == {"c1": "verified", "c2": "verified"}
    assert table("fact_transactions").count() == 5
    assert table("dim_date").count() == 32
    got = {(r.merchant_id, str(r.txn_date)): (r.txns, r.net_amount, r.returned)
           for r in table("merchant_performance_daily").collect()}
    assert got[("m1", "2026-03-01")] == (3, 7.0, 1)
    card = {r.customer_id: (r.txns, r.amount) for r in table("customer_risk_scorecard").collect()}
    assert card == {"c1": (2, 6.0), "c2": (1, 20.0)}
    assert all(table(name).count() > 0 for name in jobs.GOLD_TABLES)


def test_one_truth_about_a_customer(spark, lake):
    """After an out-of-order delivery the flags and attributes of facts are those of the dimension."""
    dim = {r.customer_id: r for r in spark.read.parquet(jobs.gold_path(lake, "dim_customer")).collect()}
    known = read_silver(spark, lake, "transactions_enriched").where("NOT is_orphan_customer AND customer_id IS NOT NULL").collect()
    assert {r.customer_id for r in known} == set(dim) == {"c1", "c2"}
    assert all((r.kyc_status, r.signup_date) == (dim[r.customer_id].kyc_status, dim[r.customer_id].signup_date) for r in known)
    assert all(r.is_signup_date_suspect == (r.txn_date < dim[r.customer_id].signup_date) for r in known)
    flagged = read_silver(spark, lake, "customers_flagged").collect()
    assert {r.customer_id: r.signup_date for r in flagged} == {c: r.signup_date for c, r in dim.items()}
    history = spark.read.parquet(f"{jobs.history_path(lake)}/state").where("customer_id = 'c2'")
    assert sorted({r.kyc_status for r in history.collect()}) == ["rejected", "verified"]


def test_scorecard_over_the_lake(spark, lake):
    card = jobs.check_quality(spark, lake, F.lit("2026-05-01").cast("date"))
    found = {(r.check_name, r.subject): r.value for r in scorecard.findings(card).collect()}
    assert found[("orphan_rows", "transactions.customer_id -> customers.customer_id")] == 1
    assert found[("gap_days", "transactions.txn_timestamp")] == 29
    assert scorecard.verdict(card).first().verdict == "RED"


def month_files(spark, lake):
    return {r.month: r.files for r in read_silver(spark, lake, "transactions_enriched").select(
        "txn_month", F.col("_metadata.file_path").alias("f")).groupBy(F.col("txn_month").alias("month")).agg(
        F.array_sort(F.collect_set("f")).alias("files")).collect()}


def same_as_rebuilt(spark, lake):
    """The table against one built at once, row by row, a threshold of its own included."""
    kept = read_silver(spark, lake, "transactions_enriched")
    full = silver.enrich_transactions(
        read_silver(spark, lake, "transactions"), jobs.current_customers(spark, lake),
        latest_rows(read_silver(spark, lake, "merchants"), "merchant_id")).withColumn("txn_month", F.date_format("txn_date", "yyyy-MM"))
    kept, full = kept.select(sorted(kept.columns)), full.select(sorted(full.columns))
    return kept.exceptAll(full).isEmpty() and full.exceptAll(kept).isEmpty()


def test_only_touched_months_are_rewritten(spark, tmp_path):
    """Month by month: new rows, late rows, rows without a date, a customer's new data, a moved threshold."""
    cfg = Config("dev", str(tmp_path / "landing"), str(tmp_path / "lake"))
    land = cfg.landing_root
    put(f"{land}/customers/full_load/a.csv", CUSTOMERS, *[customer(f"c{i}", "pending", "2026-02-01 00:00:00") for i in (1, 2, 3)])
    put(f"{land}/merchants/full_load/a.csv", MERCHANTS, "m1,Shop,5411,food,US,2020-01-01,1.5")
    put(f"{land}/device_session_logs/2026/03/a.json", json.dumps(SESSION))
    for month, cust in ((1, "c1"), (2, "c2"), (3, "c3")):
        put(f"{land}/transactions/2026/0{month}/a.csv", HEADER, *[line(100 * month + i, cust, f"{100 * month + i}.00", f"2026-0{month}-05") for i in range(5)])
    put(f"{land}/transactions/2026/03/b.csv", HEADER, line(399, "c3", "9999.00", "2026-03-06"))

    def step(*files):
        for path, *lines in files:
            put(f"{land}/{path}", *lines)
        ingest_all(spark, cfg, "r")
        before = month_files(spark, cfg) if files else {}
        months = jobs.build_silver(spark, cfg)
        after = month_files(spark, cfg)
        rewritten = {m for m in after if after[m] != before.get(m)}
        assert same_as_rebuilt(spark, cfg)
        return months, rewritten
    assert step() == (None, {"2026-01", "2026-02", "2026-03"})
    # A late row of January and one without a date; both are below the threshold, which stays.
    undated = line(151, "c2", "2.00", "2026-01-09").removesuffix("2026-01-09")
    assert step(("transactions/2026/01/late.csv", HEADER, line(150, "c2", "1.00", "2026-01-09")),
                ("transactions/2026/04/undated.csv", HEADER, undated)) == ([None, "2026-01"], {None, "2026-01"})
    # c3 is known otherwise: its month only. A larger amount than any moves the threshold; no other row lies between.
    assert step(("customers/full_load/b.csv", CUSTOMERS, customer("c3", "verified", "2026-02-09 00:00:00")),
                ("transactions/2026/05/big.csv", HEADER, line(500, "c1", "20000.00", "2026-05-01"))) == (
        ["2026-03", "2026-05"], {"2026-03", "2026-05"})


def test_flagged_tables_and_thresholds(spark, lake):
    logs = read_silver(spark, lake, "device_session_logs_enriched")
    assert {"is_geo_velocity_anomaly", "is_geo_low_accuracy", "is_orphan_customer", "event_date", "geo"} <= set(logs.columns)
    assert logs.count() == read_silver(spark, lake, "device_session_logs").count()
    suspects = {r.customer_id: r.is_signup_date_suspect for r in read_silver(spark, lake, "customers_flagged").collect()}
    assert suspects == {"c1": False, "c2": False}
    found = {r.metric: (r.observed, r.status) for r in jobs.check_thresholds(spark, lake).collect()}
    assert found["orphan_rate_pct"] == (20.0, "FAIL") and set(found) == {
        "orphan_rate_pct", "pre_signup_rate_pct", "amount_outlier_rate_pct", "geo_velocity_anomaly_rate_pct"}
    plain, hidden = read_silver(spark, lake, "customers"), jobs.masked(spark, lake, "customers")
    assert hidden.columns == plain.columns and hidden.where("full_name = 'Name'").isEmpty()
