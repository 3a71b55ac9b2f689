import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.config import ForeignKey
from tidemark.operators import distribution, integrity, lifecycle, nested, pii, profile, thresholds, timeline, velocity
from tidemark.operators.sequence import SkewPolicy


def day(text):
    return F.lit(text).cast("date")


def as_dict(df):
    return {(r.metric, r.column_name): r.value for r in df.collect()}


# ---- profile ---------------------------------------------------------------------------------

def test_profile_counts_duplicates_and_nulls(spark):
    df = spark.createDataFrame([
        (1, "a", None), (1, "a", None),      # full duplicate
        (1, None, "a"),                      # same values, other columns: key duplicate only
        (2, "", "x"), (2, None, "x"),        # empty text is not null
        (None, "a", "b"), (None, "a", "b"),  # null key
        (3, "z", "z"),
    ], "id int, a string, b string")
    got = as_dict(profile.profile(df, ["id"]))
    assert got[("rows", None)] == 8
    assert got[("full_row_duplicates", None)] == 2
    assert got[("key_duplicates", "id")] == 8 - 4
    assert got[("nulls", "a")] == 2 and got[("nulls", "b")] == 2 and got[("nulls", "id")] == 2
    assert df.count() - df.dropDuplicates().count() == 2
    assert df.count() - df.dropDuplicates(["id"]).count() == 4


def test_profile_tells_struct_null_from_field_null(spark):
    df = spark.createDataFrame([
        (1, None), (1, (None, None)), (1, (1.0, None)), (1, (None, "x")), (1, (None, "x")),
    ], "id int, geo struct<lat double, city string>")
    got = as_dict(profile.profile(df, ["id"]))
    assert got[("full_row_duplicates", None)] == 1
    assert got[("nulls", "geo")] == 1
    assert ("nulls", "lat") not in got


def test_profile_many_columns_and_random_rows(spark):
    rng = random.Random(1)
    cols = [f"c{i}" for i in range(70)]
    base = [[rng.choice([None, 0, 1]) for _ in cols] for _ in range(40)]
    rows = [tuple([i % 25] + rng.choice(base)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} int" for c in cols))
    got = as_dict(profile.profile(df, ["id"]))
    assert got[("full_row_duplicates", None)] == len(rows) - len(set(rows))
    for i, c in enumerate(cols, start=1):
        assert got[("nulls", c)] == sum(r[i] is None for r in rows)


def test_profile_of_nothing(spark):
    got = as_dict(profile.profile(spark.createDataFrame([], "id int, a string"), ["id"]))
    assert set(got.values()) == {0}


def test_profile_shuffles_no_payload(spark):
    df = spark.createDataFrame([(1, "x" * 100)], "id int, wide string")
    plan = profile.profile(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("wide" not in line for line in exchanges)


def test_cast_validation(spark):
    df = spark.createDataFrame([("1.5", "2024-01-01"), ("x", "2024-13-01"), (None, None), ("7", "2024-01-02")],
                               "a string, d string")
    got = {r.column_name: r for r in profile.validate_casts(df, [("a", "double"), ("d", "date")]).collect()}
    assert (got["a"].non_null_rows, got["a"].cast_failures, got["a"].failure_pct, got["a"].status) == (3, 1, 33.33, "FAIL")
    assert got["d"].cast_failures == 1
    empty = profile.validate_casts(df.where("a = 'none'"), [("a", "double")]).first()
    assert (empty.cast_failures, empty.failure_pct, empty.status) == (0, 0.0, "PASS")


def test_cardinality_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    row = profile.cardinality(df, ["k"]).first()
    assert (row.total_rows, row.distinct_values, row.rows_per_value) == (5, df.distinct().count(), 1.67)
    nothing = profile.cardinality(df.where("k > 9"), ["k"]).first()
    assert (nothing.distinct_values, nothing.rows_per_value) == (0, 0.0)


def test_cardinality_counts_each_column_by_itself(spark):
    """Distinct counts of several columns in one aggregate would move every row once per column."""
    df = spark.createDataFrame([(1, "a", 0.0), (2, "a", -0.0), (3, None, float("nan")), (4, None, float("nan")), (5, "b", None)],
                               "i int, s string, x double")
    out = profile.cardinality(df, ["i", "s", "x"])
    assert [tuple(r) for r in out.collect()] == [("i", 5, 5, 1.0), ("s", 5, 3, 1.67), ("x", 5, 3, 1.67)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Aggregate [i" in plan


# ---- integrity -------------------------------------------------------------------------------

def test_integrity_with_null_keys_hot_key_and_repeated_parent(spark):
    child = spark.createDataFrame([(1,)] * 50 + [(2,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "p int")
    row = integrity.integrity_check(child, "k", parent, "p", "c -> p").first()
    assert (row.non_null_rows, row.orphan_rows, row.orphan_pct, row.status) == (53, 2, 3.7736, "FAIL")
    assert [r.k for r in integrity.orphan_rows(child, "k", parent, "p").collect()] == [9, 9]
    clean = integrity.integrity_check(child.where("k < 3"), "k", parent, "p", "x").first()
    assert (clean.orphan_rows, clean.status) == (0, "PASS")
    none = integrity.integrity_check(child.where("k > 99"), "k", parent, "p", "x").first()
    assert (none.non_null_rows, none.orphan_pct, none.status) == (0, 0.0, "PASS")


def test_checks_of_one_key_share_its_counts(spark):
    """Cardinality and every relation of a key need the same counts: the child's keys are read once."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def key(x):
        read.add(1)
        return None if x % 10 == 0 else x % 7
    child = spark.range(0, 1000, 1, 2).select(key("id").alias("k"))
    tables = {"c": child, "p": spark.range(3).toDF("k"), "q": spark.range(9).toDF("k")}
    ri = integrity.integrity_checks(tables, [ForeignKey("c", "k", "p", "k"), ForeignKey("c", "k", "q", "k")])
    both = profile.cardinality(child, ["k"]).select("total_rows", "distinct_values").unionByName(
        ri.selectExpr("non_null_rows AS total_rows", "orphan_rows AS distinct_values"))
    orphans = sum(1 for x in range(1000) if x % 10 and x % 7 >= 3)
    assert [tuple(r) for r in both.collect()] == [(1000, 8), (900, orphans), (900, 0)]
    assert read.value == 1000


def test_integrity_of_all_relations(spark):
    tables = {"a": spark.createDataFrame([(1,), (5,)], "x int"), "b": spark.createDataFrame([(1,)], "y int")}
    got = integrity.integrity_checks(tables, [ForeignKey("a", "x", "b", "y"), ForeignKey("b", "y", "a", "x")])
    assert {r.check_name: r.orphan_rows for r in got.collect()} == {"a.x -> b.y": 1, "b.y -> a.x": 0}


# ---- distributions ---------------------------------------------------------------------------

def test_amount_stats_on_text(spark):
    df = spark.createDataFrame([("-1.5",), ("0",), ("10",), ("oops",), (None,)], "amount string")
    row = distribution.amount_stats(df, "amount").first()
    assert (row.non_null_count, row.min_amount, row.max_amount, row.negative_count, row.zero_count,
            row.median_amount) == (3, -1.5, 10.0, 1, 1, 0.0)


def test_shares_sum_to_hundred_and_keep_null_group(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    got = {r.c: (r.n, r.pct) for r in distribution.breakdown(df, "c").collect()}
    assert got == {"a": (2, 50.0), "b": (1, 25.0), None: (1, 25.0)}


def test_outliers_are_strictly_above(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 2001)] + [(1998.0,)], "amount double")
    got = sorted(r.amount for r in distribution.amount_outliers(df, "amount").collect())
    assert got == [1999.0, 2000.0]
    flagged = distribution.flag_outliers(df, "amount")
    assert flagged.count() == 2001 and flagged.where("is_amount_outlier").count() == 2


def test_round_amounts(spark):
    df = spark.createDataFrame([(1000.0,), (100.0,), (99.99,), (2000.01,), (5000.0,), (300.0,)], "amount double")
    row = distribution.round_amounts(df, "amount").first()
    assert (row.n, row.round_1000, row.round_100) == (6, 2, 2)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_heavy_share_matches_ranking(spark, seed):
    rng = random.Random(seed)
    keys = [1] * 200 + [rng.randrange(2, 40) for _ in range(400)]
    row = distribution.heavy_share(spark.createDataFrame([(k,) for k in keys], "k int"), "k").first()
    counts = sorted((keys.count(k) for k in set(keys)), reverse=True)
    wanted = max(1, int(len(counts) * 0.2))
    assert (row.heavy_keys, row.heavy_rows, row.all_rows) == (wanted, sum(counts[:wanted]), 600)


def test_label_rate_puts_null_keys_with_the_rest(spark):
    facts = spark.createDataFrame([(1, True), (1, False), (2, True), (None, True)], "k int, y boolean")
    flagged = spark.createDataFrame([(1,), (1,)], "k int")
    got = {r.flagged: (r.total_rows, r.labelled_rows, r.rate_pct)
           for r in distribution.label_rate_by_flag(facts, "k", F.col("y"), flagged).collect()}
    assert got == {True: (2, 1, 50.0), False: (2, 2, 100.0)}


# ---- time ------------------------------------------------------------------------------------

def test_gap_days_and_future(spark):
    df = spark.createDataFrame([("2024-02-27",), ("2024-02-27",), ("2024-03-02",), (None,)], "d string").select(
        F.col("d").cast("date").alias("d"))
    daily = timeline.daily_volume(df, "d")
    got = sorted(r.day for r in timeline.gap_days(daily).collect())
    assert got == [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]
    assert timeline.gap_days(timeline.daily_volume(df.where("d > '2030-01-01'"), "d")).count() == 0
    row = timeline.future_dated(df, "d", day("2024-02-28")).first()
    assert (row.future_rows, row.status) == (1, "FAIL")


def test_age_sanity(spark):
    df = spark.createDataFrame([("2030-01-01",), ("2006-06-01",), ("2006-06-02",), ("1924-06-01",), ("1924-05-31",)],
                               "d string").select(F.col("d").cast("date").alias("d"))
    row = timeline.age_sanity(df, F.col("d"), day("2024-06-01")).first()
    assert (row.future_birth, row.under_18, row.over_100) == (1, 2, 1)


# ---- lifecycle -------------------------------------------------------------------------------

@pytest.fixture
def early(spark):
    parent = spark.createDataFrame([(1, "2024-01-10", "s"), (2, "2025-01-01", "t"), (3, "2020-01-01", "s")],
                                   "k int, since string, seg string").withColumn("since", F.col("since").cast("date"))
    child = spark.createDataFrame([(1, "2024-01-09"), (1, "2024-01-10"), (1, "2024-01-03"), (2, "2023-12-31"),
                                   (3, "2021-01-01"), (9, "1990-01-01"), (None, "1990-01-01")],
                                  "k int, d string").withColumn("d", F.col("d").cast("date"))
    return parent, child, lifecycle.pre_lifecycle(child, parent, "k", F.col("d"), F.col("since"), (), ["seg"])


def test_pre_lifecycle_detail_and_statistics(early):
    parent, child, detail = early
    assert sorted(r.days_before for r in detail.collect()) == [1, 7, 367]
    summary = lifecycle.affected_summary(detail, "k").first()
    assert (summary.affected_rows, summary.affected_keys) == (3, 2)
    s = lifecycle.gap_stats(detail).first()
    assert (s.min_days, s.max_days, s.mean_days, s.median_days, s.p99_days) == (1, 367, 125.0, 7, 367)
    assert (s.within_1_day, s.within_7_days, s.over_1_year) == (1, 2, 1)
    assert {r.gap_bucket: r.n for r in lifecycle.gap_buckets(detail).collect()} == {
        "0-1 days": 1, "2-7 days": 1, "over 365 days": 1}
    got = {r.seg: (r.affected_keys, r.affected_rows, r.total_keys, r.affected_pct)
           for r in lifecycle.concentration(detail, "seg", "k", parent).collect()}
    assert got == {"s": (1, 2, 2, 50.0), "t": (1, 1, 1, 100.0)}


def test_overwrite_check(spark, early):
    parent, child, _ = early
    parent = parent.withColumn("changed", F.when(F.col("k") == 1, day("2024-01-20")).otherwise(day("2019-01-01")))
    firsts = timeline.first_seen(child, "k", F.col("d"))
    checked = lifecycle.overwrite_check(parent, firsts, "k", F.col("since"), F.col("changed"))
    row = lifecycle.overwrite_stats(checked).first()
    assert (row.affected, row.updated_after, row.mean_days_after, row.updated_pct) == (2, 1, 10.0, 50.0)


# ---- nested ----------------------------------------------------------------------------------

@pytest.fixture
def sessions(spark):
    return spark.createDataFrame([
        (1, 10, None), (2, 11, (None, 5.0)), (3, 12, (90.0001, 180.0)), (4, 13, (-90.0, -180.5)), (5, 14, (90.0, 0.0)),
    ], "id int, ts int, geo struct<lat double, long double>")


def test_nested_nulls_and_range(sessions):
    got = {r.field: (r.nulls, r.status) for r in nested.nested_nulls(sessions, {"geo": ["lat", "long"]}).collect()}
    assert got == {"geo__struct": (1, "FAIL"), "geo__lat": (1, "FAIL"), "geo__long": (0, "PASS")}
    row = nested.geo_range(sessions).first()
    assert (row.invalid_lat, row.invalid_long, row.lat_min, row.long_max) == (1, 1, -90.0, 180.0)


def test_schema_drift_at_both_ends(sessions):
    flat = nested.flatten_structs(sessions, {"geo": ["lat", "long"]})
    got = {r.sub_field: (r.null_oldest, r.null_newest, r.status)
           for r in nested.schema_drift(flat, ["ts", "id"], ["lat", "long"], 2).collect()}
    assert got == {"lat": (2, 0, "DRIFT"), "long": (1, 0, "DRIFT")}
    assert flat.columns == ["id", "ts", "lat", "long"]


# ---- velocity --------------------------------------------------------------------------------

FIX = "k int, t timestamp_ntz, id int, lat double, lng double, acc double"


def fixes(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        (1, t, 1, 0.0, 0.0, None),
        (1, t, 2, 0.0, 1.0, 50.0),                          # same second: one second is assumed
        (1, t + dt.timedelta(hours=1), 3, 0.0, 1.0, 100.0),  # no movement
        (1, t + dt.timedelta(hours=2), 4, None, 1.0, None),  # skipped
        (1, t + dt.timedelta(hours=3), 5, 0.0, 19.0, 99.0),  # 2001.5 km in two hours
        (2, t, 6, 10.0, 10.0, None),                         # alone
    ], FIX)


def test_coordinates_are_worked_out_once_per_row(spark):
    asked = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def lat(x):
        asked.add(1)
        return None if x % 5 == 0 else float(x % 90)
    df = spark.range(0, 1000, 1, 2).select(
        F.col("id"), (F.col("id") % 4).alias("k"), F.timestamp_seconds("id").alias("t"),
        lat("id").alias("lat"), F.lit(0.0).alias("lng"))
    pairs = velocity.velocity_pairs(df, "k", "t", "id", "lat", "lng")
    assert pairs.columns == ["id", "k", "t", "lat", "lng", "prev", "dist_km", "time_hours", "speed_kmh"]
    assert pairs.agg(F.count("prev")).first()[0] == 796
    assert 1000 <= asked.value <= 1020


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(1, 1, 1)])
def test_velocity_pairs(spark, policy):
    pairs = velocity.velocity_pairs(fixes(spark), "k", "t", "id", "lat", "lng", ["acc"], policy)
    got = {r.id: r for r in pairs.collect()}
    assert set(got) == {2, 3, 5}
    assert abs(got[2].speed_kmh - 111.195 * 3600) < 10 and got[2].prev.acc is None
    assert got[3].speed_kmh == 0.0
    assert abs(got[5].speed_kmh - 1000.75) < 0.5 and got[5].prev.acc == 100.0
    assert {r.id for r in velocity.impossible(pairs).collect()} == {2, 5}


def test_accuracy_and_flags(spark):
    fast = velocity.impossible(velocity.velocity_pairs(fixes(spark), "k", "t", "id", "lat", "lng"))
    row = velocity.accuracy_stats(fast, "acc").first()
    assert (row.pairs, row.missing, row.min_m, row.max_m, row.reliable) == (2, 0, 50.0, 99.0, 2)
    flags = {r.id: (r.is_geo_velocity_anomaly, r.is_geo_low_accuracy, r.is_geo_accuracy_missing)
             for r in velocity.flag_geo(fixes(spark), "k", "t", "id", "lat", "lng", "acc").collect()}
    assert len(flags) == 6
    assert flags[2] == (True, False, False) and flags[3] == (False, True, False)
    assert flags[4] == (False, False, True) and flags[6] == (False, False, True)


# ---- personal data and thresholds ------------------------------------------------------------

def test_inventory_order_and_counts(spark):
    t = spark.createDataFrame([("a", None, ("x",)), ("b", "n", None)], "id string, name string, geo struct<city string>")
    inv = pii.pii_inventory({"t": t}, [("t", "id", "Medium"), ("t", "name", "High"), ("t", "geo.city", "Low")])
    got = [(r.column_name, r.sensitivity, r.total_rows, r.populated_rows) for r in inv.collect()]
    assert got == [("name", "High", 2, 1), ("id", "Medium", 2, 2), ("geo.city", "Low", 2, 1)]


def test_value_status(spark):
    df = spark.createDataFrame([("0",), ("1",), ("N/A",), (None,)], "v string")
    got = [r.s for r in df.select(thresholds.value_status(F.col("v")).alias("s")).collect()]
    assert got == ["PASS", "FAIL", "N/A", "N/A"]


def test_threshold_rules(spark):
    rows = [("orphan_rate_pct", 0.0001), ("pre_signup_rate_pct", 10.0), ("geo_velocity_anomaly_rate_pct", 0.1),
            ("amount_outlier_rate_pct", 5.0), ("unheard_of", 1.0)]
    got = {r.metric: r.status for r in thresholds.threshold_check(
        spark.createDataFrame(rows, "metric string, observed double"), tolerance=1.0).collect()}
    assert got == {"orphan_rate_pct": "FAIL", "pre_signup_rate_pct": "ALERT", "geo_velocity_anomaly_rate_pct": "OK",
                   "amount_outlier_rate_pct": "ALERT", "unheard_of": "N/A"}


def test_array_and_map_columns_are_compared_with_their_nulls(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, array(1, null), map('a', 1)), (1, array(1), map('a', 1)), (2, array(3), map('a', null)),
        (2, array(3), map('b', null)), (3, array(4), map('c', 1)), (3, array(4), map('c', 1)) AS t(k, x, m)""")
    got = {(r.metric, r.column_name): r.value for r in profile.profile(df, ["k"]).collect()}
    assert 1 in [v for (metric, _), v in got.items() if "dup" in metric and "row" in metric]


def test_sums_of_very_large_amounts(spark):
    df = spark.createDataFrame([("a", 1e17), ("a", 3e17), ("b", 0.001), ("b", 0.003), ("c", 1e30)], "d string, x double")
    got = {r.d: r.avg_amount for r in distribution.outlier_breakdown(df, "d", "x").collect()}
    assert got["a"] == 2e17 and got["b"] == 0.0 and got["c"] is None
