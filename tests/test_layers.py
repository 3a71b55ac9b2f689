import datetime as dt
import os
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tidemark.operators.sequence import SkewPolicy
from tidemark.plans import enriched as monthly
from tidemark.plans import gold, scd2, scorecard, silver

T0 = dt.datetime(2024, 1, 1)


def observations(seed, n=200):
    """A third of the log belongs to one key."""
    rng = random.Random(seed)
    return [(1 if i % 3 == 0 else rng.randrange(2, 9), rng.choice("ab"), rng.choice(["x", None]),
             T0 + dt.timedelta(minutes=i)) for i in range(n)]


def brute_scd2(rows):
    out, groups = set(), {}
    for k, a, b, t in sorted(rows, key=lambda r: r[3]):
        groups.setdefault(k, []).append((a, b, t))
    for k, log in groups.items():
        versions = [r for i, r in enumerate(log) if i == 0 or r[:2] != log[i - 1][:2]]
        for i, (a, b, t) in enumerate(versions):
            until = versions[i + 1][2] if i + 1 < len(versions) else None
            out.add((k, a, b, t, until, until is None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, a string, b string, t timestamp_ntz")


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(10, 1, 10)])
def test_scd2_matches_brute_force(spark, policy):
    rows = observations(5)
    got = scd2.scd2(frame(spark, rows), "k", ["a", "b"], "t", policy=policy)
    assert {tuple(r) for r in got.collect()} == brute_scd2(rows)
    per_key = got.groupBy("k").agg(F.count_if("is_current").alias("n")).collect()
    assert all(r.n == 1 for r in per_key)


def test_scd2_same_time_highest_tie_wins(spark):
    df = spark.createDataFrame([(1, "a", T0, 1), (1, "b", T0, 2)], "k int, a string, t timestamp_ntz, seq int")
    assert [tuple(r) for r in scd2.scd2(df, "k", ["a"], "t", "seq").collect()] == [(1, "b", T0, None, True)]


def test_scd2_merge_equals_full_build(spark):
    rows = observations(8)
    dim = scd2.scd2(frame(spark, rows[:120]), "k", ["a", "b"], "t")
    merged = scd2.scd2_merge(dim, frame(spark, rows), frame(spark, rows[120:]), "k", ["a", "b"], "t")
    assert {tuple(r) for r in merged.collect()} == brute_scd2(rows)


def test_scd2_merge_late_row_and_untouched_keys(spark):
    old = [(1, "a", None, T0), (1, "c", None, T0 + dt.timedelta(2)), (2, "z", None, T0)]
    new = [(1, "b", None, T0 + dt.timedelta(1))]
    dim, late, log = scd2.scd2(frame(spark, old), "k", ["a", "b"], "t"), frame(spark, new), frame(spark, old + new)
    got = {tuple(r) for r in scd2.scd2_merge(dim, log, late, "k", ["a", "b"], "t").collect()}
    d1, d2 = T0 + dt.timedelta(1), T0 + dt.timedelta(2)
    assert got == {(1, "a", None, T0, d1, False), (1, "b", None, d1, d2, False), (1, "c", None, d2, None, True),
                   (2, "z", None, T0, None, True)}


def test_scd2_merge_rebuilds_the_null_key_once(spark):
    old, new = [(None, "a", None, T0), (2, "z", None, T0)], [(None, "b", None, T0 + dt.timedelta(1))]
    dim = scd2.scd2(frame(spark, old), "k", ["a", "b"], "t")
    got = scd2.scd2_merge(dim, frame(spark, old + new), frame(spark, new), "k", ["a", "b"], "t").collect()
    assert sorted((r.k or 0, r.a, r.is_current) for r in got) == [(0, "a", False), (0, "b", True), (2, "z", True)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_rows_between_repeats(spark, tmp_path, seed):
    """Shuffled batches: a late row may fall between two repeats of one value."""
    rows = observations(seed, 90)
    shuffled = random.Random(seed).sample(rows, len(rows))
    apply, path = scd2.merge_batch(str(tmp_path / "dim"), "k", ["a", "b"], "t"), str(tmp_path / "dim")
    for i in range(3):
        apply(frame(spark, shuffled[i::3]), i)
    assert {tuple(r) for r in scd2.current_version(spark, path).collect()} == brute_scd2(rows)


def test_merge_batch_is_repeatable(spark, tmp_path):
    rows, path = observations(9), str(tmp_path / "dim")
    apply = scd2.merge_batch(path, "k", ["a", "b"], "t")
    apply(frame(spark, rows[:100]), 0)
    for _ in range(2):
        apply(frame(spark, rows[100:]), 1)
    assert {tuple(r) for r in scd2.current_version(spark, path).collect()} == brute_scd2(rows)


def test_scd2_as_a_stream(spark, tmp_path):
    rows = observations(11)
    for i, part in enumerate((rows[:90], rows[90:])):
        frame(spark, part).coalesce(1).write.parquet(str(tmp_path / f"in/part={i}"))
    stream = (spark.readStream.schema("k int, a string, b string, t timestamp_ntz").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(str(tmp_path / "in")))
    out = str(tmp_path / "dim")
    (stream.writeStream.foreachBatch(scd2.merge_batch(out, "k", ["a", "b"], "t"))
     .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination())
    assert {tuple(r) for r in scd2.current_version(spark, out).collect()} == brute_scd2(rows)


def sizes(files):
    return sum(os.path.getsize(unquote(f.removeprefix("file://"))) for f in files)


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, tmp_path, monkeypatch):
    """One percent of the keys: less than five percent of the log and of the state is read and written."""
    path = str(tmp_path / "dim")
    apply = scd2.merge_batch(path, "k", ["a"], "t", buckets=256)
    first = spark.range(2000).selectExpr("CAST(id % 1000 AS INT) AS k", "concat('a', id) AS a", "timestamp_seconds(id) AS t")
    apply(first, 0)
    whole = {what: sizes(spark.read.parquet(f"{path}/{what}/version=0").inputFiles()) for what in ("log", "state")}
    read, plain = [], scd2.read_buckets

    def seen(spark, path, what, written):
        out = plain(spark, path, what, written)
        read.append((what, sizes(out.inputFiles())))
        return out
    monkeypatch.setattr(scd2, "read_buckets", seen)
    apply(spark.range(10).selectExpr("CAST(id * 97 AS INT) AS k", "'new' AS a", "timestamp_seconds(9000 + id) AS t"), 1)
    for what in ("log", "state"):
        assert 0 < max(n for w, n in read if w == what) < 0.05 * whole[what]
        assert sizes(spark.read.parquet(f"{path}/{what}/version=1").inputFiles()) < 0.05 * whole[what]
    monkeypatch.undo()
    got = scd2.current_version(spark, path)
    assert got.where("is_current").count() == 1000 and got.where("a = 'new' AND is_current").count() == 10


def test_replaced_buckets_are_removed_one_batch_later(spark, tmp_path):
    path = str(tmp_path / "dim")
    apply = scd2.merge_batch(path, "k", ["a"], "t", buckets=4)
    rows = [[(k, f"a{i}", T0 + dt.timedelta(days=i)) for k in (1, 2, 3, None)] for i in range(4)]
    for i, part in enumerate(rows):
        apply(spark.createDataFrame(part, "k int, a string, t timestamp"), i)
    assert sorted(os.listdir(f"{path}/manifest")) == ["version=2", "version=3"]
    assert [len([d for d in os.listdir(f"{path}/state/version={i}") if d.startswith("bucket=")]) > 0 for i in range(4)] == [False, False, True, True]
    assert scd2.current_version(spark, path).count() == 16


def test_a_failed_batch_leaves_readers_on_the_state_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dim")
    apply = scd2.merge_batch(path, "k", ["a"], "t")
    apply(spark.createDataFrame([(1, "a", T0)], "k int, a string, t timestamp"), 0)
    news = spark.createDataFrame([(1, "b", T0 + dt.timedelta(days=1)), (5, "c", T0)], "k int, a string, t timestamp")

    def broken(*args, **kwargs):
        raise OSError("lost")
    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(scd2, "scd2_merge", broken)
        apply(news, 1)
    assert [tuple(r)[:2] for r in scd2.current_version(spark, path).collect()] == [(1, "a")]
    apply(news, 1)
    assert sorted(tuple(r)[:2] for r in scd2.current_version(spark, path).collect()) == [(1, "a"), (1, "b"), (5, "c")]


def test_batches_without_rows(spark, tmp_path):
    path = str(tmp_path / "dim")
    apply = scd2.merge_batch(path, "k", ["a"], "t")
    none = spark.createDataFrame([], "k int, a string, t timestamp")
    apply(none, 0)
    assert scd2.current_version(spark, path).count() == 0
    apply(spark.createDataFrame([(1, "a", T0)], "k int, a string, t timestamp"), 1)
    apply(none, 2)
    assert scd2.current_version(spark, path).count() == 1


def test_a_moved_threshold_restates_only_rows_between(spark, tmp_path):
    """Half of the amounts are outliers here: new rows in March move the threshold over rows of February, not of January."""
    customers = spark.createDataFrame([("c1", "retail", "low", "ok", dt.date(2020, 1, 1))], "customer_id string, segment string, risk_band string, kyc_status string, signup_date date")
    merchants = spark.createDataFrame([("m1", "Shop", "food", 1.0, 5411)], "merchant_id string, merchant_name string, category string, merchant_risk_score double, mcc_code int")
    rows = [(f"t{a}", "c1", "m1", 5411, float(a), dt.date(2026, month, 1), 0) for month, amounts in ((1, range(1, 8)), (2, range(20, 28))) for a in amounts]
    more = [(f"t{a}", "c1", "m1", 5411, float(a), dt.date(2026, 3, 1), 1) for a in range(40, 46)]
    schema = "transaction_id string, customer_id string, merchant_id string, mcc_code int, amount double, txn_date date, load int"
    table, state = str(tmp_path / "table"), str(tmp_path / "state")

    def refresh(data):
        months = monthly.refresh(spark.createDataFrame(data, schema), customers, merchants, table, state, "load", 0.5)
        got = {r.transaction_id: r.is_amount_outlier for r in spark.read.parquet(table).collect()}
        middle = sorted(r[4] for r in data)[(len(data) + 1) // 2 - 1]
        assert got == {r[0]: r[4] > middle for r in data}
        return months
    assert refresh(rows) is None
    assert refresh(rows + more) == ["2026-02", "2026-03"]
    # A refresh that fails before it says so is done again.
    late = [*rows, *more, ("late", "c1", "m1", 5411, 3.0, dt.date(2026, 1, 2), 2)]
    with pytest.MonkeyPatch.context() as m, pytest.raises(OSError):
        m.setattr(monthly, "enrich_transactions", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        refresh(late)
    assert refresh(late)[0] == "2026-01"


LANDED = ("transaction_id string, customer_id string, txn_timestamp string, amount string, mcc_code string, "
          "is_fraud_flag string, txn_date string, channel string")


def test_quarantine_splits_without_loss(spark):
    df = spark.createDataFrame([
        ("t1", "c1", "2024-01-01 10:00:00", "10.50", "5411", "true", "2024-01-01", "POS"),
        ("t2", None, "2024-01-01 10:00:00", "-3", "5411", "false", "2024-01-01", "POS"),
        ("t3", "c1", "bad", "x", None, "maybe", "2024-02-30", "ATM"),
        ("t4", "c1", None, None, None, None, None, None),
        ("t5", "c2", "2024-01-02 10:00:00", "-1", "1", "false", "2024-01-02", "ATM"),
    ], LANDED)
    good, bad = silver.split_quarantine(df, "transactions")
    assert good.count() + bad.count() == df.count()
    reasons = {r.transaction_id: r.reject_reasons for r in bad.collect()}
    assert reasons == {"t3": ["bad_txn_timestamp", "bad_amount", "bad_is_fraud_flag", "bad_txn_date"]}
    typed = {r.transaction_id: r for r in silver.silver_transactions(df).collect()}
    assert str(typed["t1"].amount) == "10.50" and typed["t1"].is_fraud_flag is True
    assert typed["t2"].is_missing_customer and not typed["t1"].is_missing_customer
    assert typed["t5"].is_negative_amount and not typed["t4"].is_negative_amount
    assert [r.amount for r in bad.where("transaction_id = 't3'").collect()] == ["x"]


@pytest.fixture
def enriched(spark):
    txns = spark.createDataFrame([
        (1, 10, 7, 5411, 20.0, "2024-01-05", "POS", "approved", "USD", True, "purchase"),
        (2, 10, 8, 9999, -5.0, "2023-12-31", "POS", "approved", "USD", False, "refund"),
        (3, 99, 7, 5411, 1.0, "2024-02-01", "ATM", "declined", "USD", False, "purchase"),
        (4, None, 7, None, 500.0, "2024-02-02", "ATM", "approved", "USD", True, "purchase"),
    ], "transaction_id int, customer_id int, merchant_id int, mcc_code int, amount double, txn_date string, "
       "channel string, status string, currency string, is_fraud_flag boolean, txn_type string").withColumn(
        "txn_date", F.col("txn_date").cast("date"))
    customers = spark.createDataFrame([(10, "retail", "low", "verified", "2024-01-01"), (11, "business", "high", "pending", "2024-01-01")],
                                      "customer_id int, segment string, risk_band string, kyc_status string, signup_date string"
                                      ).withColumn("signup_date", F.col("signup_date").cast("date"))
    merchants = spark.createDataFrame([(7, "m7", 5411, "food", 1.0), (9, "m9", 5411, "food", 2.0)],
                                      "merchant_id int, merchant_name string, mcc_code int, category string, merchant_risk_score double")
    return customers, silver.enrich_transactions(txns, customers, merchants)


def test_enrichment_keeps_every_row_once(enriched):
    _, df = enriched
    got = {r.transaction_id: r for r in df.collect()}
    assert len(got) == df.count() == 4
    assert got[2].is_signup_date_suspect and not got[1].is_signup_date_suspect
    assert got[3].is_orphan_customer and not got[4].is_orphan_customer
    assert got[2].is_orphan_merchant and got[2].is_unknown_mcc and not got[1].is_unknown_mcc
    assert got[2].is_negative_amount and got[4].segment is None


def test_marts(enriched):
    customers, df = enriched
    fact = gold.fact_transactions(df)
    days = {str(r.txn_date): (r.txns, r.amount, r.flagged_txns, r.flagged_rate)
            for r in gold.daily_fraud_summary(fact).collect()}
    assert days["2024-01-05"] == (1, 20.0, 1, 1.0) and days["2023-12-31"] == (1, -5.0, 0, 0.0)
    assert all(r.label_caveat for r in gold.daily_fraud_summary(fact).collect())
    card = {r.customer_id: (r.txns, r.amount, r.flagged_txns, r.pre_signup_txns)
            for r in gold.customer_risk_scorecard(customers, fact).collect()}
    assert card == {10: (2, 15.0, 1, 1), 11: (0, 0.0, 0, 0)}
    trend = {(r.channel, r.month): (r.txns, r.prev_txns, r.txn_change)
             for r in gold.channel_volume_trends(fact).collect()}
    assert trend == {("POS", "2023-12"): (1, None, None), ("POS", "2024-01"): (1, 1, 0),
                     ("ATM", "2024-02"): (2, None, None)}
    shops = {(r.merchant_id, str(r.txn_date)): (r.txns, r.returned) for r in gold.merchant_performance_daily(fact).collect()}
    assert shops[(8, "2023-12-31")] == (1, 1) and shops[(7, "2024-01-05")] == (1, 0)
    span = gold.dim_date(fact, "txn_date")
    assert span.count() == 34
    row = span.where("date_day = '2024-01-06'").first()
    assert (row.iso_weekday, row.is_weekend, row.quarter) == (6, True, 1)


def test_suspect_customers(enriched):
    customers, df = enriched
    got = {r.customer_id: r.is_signup_date_suspect for r in silver.flag_signup_suspect(customers, df).collect()}
    assert got == {10: True, 11: False}


def tables(spark, txn_date="2024-01-02", orphan=False, gap=False, dob="1990-01-01", jump=False):
    def d(df, *cols):
        return df.withColumns({c: F.col(c).cast("date") for c in cols})
    customers = d(spark.createDataFrame([(1, "n", dob, "2024-01-01", "a")],
                                        "customer_id int, full_name string, dob string, signup_date string, address string"),
                  "dob", "signup_date")
    merchants = spark.createDataFrame([(1, "m", 10)], "merchant_id int, merchant_name string, mcc_code int")
    rows = [(1, 5, 99 if orphan else 1, 1, 10, 5.0, txn_date), (2, 5, 1, 1, 10, 5.0, "2024-01-05" if gap else txn_date)]
    txns = d(spark.createDataFrame(rows, "transaction_id int, card_id int, customer_id int, merchant_id int, "
                                         "mcc_code int, amount double, txn_date string"), "txn_date").withColumn(
        "txn_timestamp", F.col("txn_date").cast("timestamp"))
    logs = spark.createDataFrame(
        [(1, 1, "d", "1.1.1.1", T0, (0.0, 0.0, "x")), (2, 1, "d", "1.1.1.1", T0, (50.0 if jump else 0.0, 0.0, "x"))],
        "session_id int, customer_id int, device_id string, ip_address string, event_timestamp timestamp_ntz, "
        "geo struct<lat double, long double, city string>")
    return {"customers": customers, "merchants": merchants, "transactions": txns, "device_session_logs": logs}


@pytest.mark.parametrize("change, want, found", [
    ({}, ("GREEN", 0, 0), set()),
    ({"gap": True}, ("YELLOW", 0, 1), {"gap_days"}),
    ({"dob": "2020-01-01"}, ("YELLOW", 0, 1), {"under_18"}),
    ({"orphan": True}, ("RED", 1, 0), {"orphan_rows"}),
    ({"jump": True}, ("RED", 1, 0), {"impossible_velocity"}),
    ({"txn_date": "2023-12-31", "dob": "1900-01-01"}, ("RED", 1, 1), {"pre_signup", "over_100"}),
    ({"txn_date": "2024-06-02"}, ("RED", 1, 0), {"future_dated"}),
])
def test_verdict(spark, change, want, found):
    card = scorecard.scorecard(tables(spark, **change), F.lit("2024-06-01").cast("date"))
    assert tuple(scorecard.verdict(card).first()) == want
    assert {r.check_name for r in scorecard.findings(card).collect()} == found


def test_scorecard_computes_its_row_counts(spark):
    card = scorecard.scorecard(tables(spark), F.lit("2024-06-01").cast("date"))
    got = {(r.check_name, r.subject): r.value for r in card.where("section <= 2").collect()}
    assert got[("total_rows", "transactions")] == 2 and got[("distinct_pk", "customers")] == 1
    assert got[("rows_per_value", "transactions.card_id")] == 2.0
    assert {r.section for r in card.collect()} == {1, 2, 3, 4, 5, 6, 7}


def test_scorecard_moves_no_row_once_per_column(spark):
    card = scorecard.scorecard(tables(spark), F.lit("2024-06-01").cast("date"))
    assert "Expand" not in card._jdf.queryExecution().optimizedPlan().toString()
