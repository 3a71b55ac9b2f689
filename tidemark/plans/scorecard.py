"""The data-quality scorecard over the four datasets and its verdict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import FOREIGN_KEYS, OUTLIER_QUANTILE, PII_COLUMNS, PRIMARY_KEYS, ForeignKey
from tidemark.operators import distribution, integrity, lifecycle, pii, profile, timeline, velocity
from tidemark.operators.sequence import DEFAULT_POLICY, SkewPolicy
from tidemark.operators.thresholds import value_status

# Severity of a failing check: BLOCKER makes the verdict RED, WARNING makes it YELLOW.
_SEVERITY = {
    "future_dated": "BLOCKER", "pre_signup": "BLOCKER", "impossible_velocity": "BLOCKER",
    "future_birth": "WARNING", "under_18": "WARNING", "over_100": "WARNING",
    "gap_days": "WARNING", "amount_outliers": "WARNING",
}
_FAIL_WORD = {"gap_days": "WARN", "under_18": "FLAG", "over_100": "FLAG", "amount_outliers": "WARN"}


def _entry(section: int, check: str, subject: str, value: Column) -> Column:
    status = value_status(value, fail=_FAIL_WORD.get(check, "FAIL")) if check in _SEVERITY else F.lit("INFO")
    return F.struct(
        F.lit(section).alias("section"), F.lit(check).alias("check_name"), F.lit(subject).alias("subject"),
        value.cast("double").alias("value"), status.alias("status"),
        F.lit(_SEVERITY.get(check, "INFO")).alias("severity"))


def _entries(one_row: DataFrame, section: int, subject: str, cols: Mapping[str, str]) -> DataFrame:
    """Turns columns of a one-row result into scorecard lines."""
    return one_row.select(F.inline(F.array(*[
        _entry(section, check, subject, F.col(col)) for check, col in cols.items()])))


def scorecard(
    tables: Mapping[str, DataFrame], today: Column,
    foreign_keys: Iterable[ForeignKey] = FOREIGN_KEYS, policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """(section, check_name, subject, value, status, severity), one row per metric.

    Every line is computed from the tables; no row count is taken on trust.
    """
    customers, transactions = tables["customers"], tables["transactions"]
    sessions = tables["device_session_logs"]
    fanout = {
        "customers": (), "merchants": (),
        "transactions": ("customer_id", "card_id"),
        "device_session_logs": ("customer_id", "device_id"),
    }
    parts = []

    # 1 overview and 2 fan-out: each column counted once, in the same way as the keys of section 3.
    for name, extra in fanout.items():
        parts.append(profile.cardinality(tables[name], [PRIMARY_KEYS[name][0]]).select(F.inline(F.array(
            _entry(1, "total_rows", name, F.col("total_rows")),
            _entry(1, "distinct_pk", name, F.col("distinct_values"))))))
        if extra:
            parts.append(profile.cardinality(tables[name], extra).select(
                F.lit(2).alias("section"), F.lit("rows_per_value").alias("check_name"),
                F.concat(F.lit(f"{name}."), F.col("column_name")).alias("subject"),
                F.col("rows_per_value").alias("value"),
                F.lit("INFO").alias("status"), F.lit("INFO").alias("severity")))

    # 3 referential integrity.
    ri = integrity.integrity_checks(tables, foreign_keys)
    parts.append(ri.select(
        F.lit(3).alias("section"), F.lit("orphan_rows").alias("check_name"), F.col("check_name").alias("subject"),
        F.col("orphan_rows").cast("double").alias("value"), "status", F.lit("BLOCKER").alias("severity")))

    # 4 distributions, and the outlier count that the same passes give.
    amounts = distribution.amount_stats(transactions, "amount", OUTLIER_QUANTILE)
    parts.append(amounts.select(F.inline(F.array(
        *[_entry(4, c, "transactions.amount", F.col(c)) for c in (
            "min_amount", "max_amount", "mean_amount", "median_amount", "stddev_amount",
            "negative_count", "zero_count")],
        _entry(6, "amount_outliers", "transactions.amount", F.col("outlier_rows"))))))

    # 5 time. Future rows and missing days both come from the daily counts.
    daily = timeline.daily_volume(transactions, "txn_timestamp")
    future = daily.agg(F.coalesce(F.sum(F.when(F.col("day") > today, F.col("n"))), F.lit(0)).alias("n"))
    parts.append(_entries(future, 5, "transactions.txn_timestamp", {"future_dated": "n"}))
    early = lifecycle.pre_lifecycle(
        transactions, customers, "customer_id", F.col("txn_date"), F.col("signup_date"))
    parts.append(_entries(early.agg(F.count(F.lit(1)).alias("n")), 5, "transactions.txn_date", {"pre_signup": "n"}))
    gaps = timeline.gap_days(daily)
    parts.append(_entries(gaps.agg(F.count(F.lit(1)).alias("n")), 5, "transactions.txn_timestamp", {"gap_days": "n"}))
    parts.append(_entries(timeline.age_sanity(customers, F.col("dob"), today), 5, "customers.dob", {
        c: c for c in ("future_birth", "under_18", "over_100")}))

    # 6 travel.
    fixes = sessions.select("customer_id", "session_id", "event_timestamp",
                            F.col("geo.lat").alias("lat"), F.col("geo.long").alias("lng"))
    fast = velocity.impossible(velocity.velocity_pairs(
        fixes, "customer_id", "event_timestamp", "session_id", "lat", "lng", policy=policy))
    parts.append(_entries(fast.agg(F.count(F.lit(1)).alias("n")), 6, "device_session_logs.geo",
                          {"impossible_velocity": "n"}))

    # 7 personal data.
    totals = pii.pii_totals(pii.pii_inventory(tables, PII_COLUMNS))
    parts.append(totals.select(
        F.lit(7).alias("section"), F.lit("tagged_columns").alias("check_name"),
        F.col("sensitivity").alias("subject"), F.col("tagged_columns").cast("double").alias("value"),
        F.lit("INFO").alias("status"), F.lit("INFO").alias("severity")))
    return reduce(DataFrame.unionByName, parts)


def findings(card: DataFrame) -> DataFrame:
    """Only the lines that count against the data."""
    return card.where(F.col("severity").isin("BLOCKER", "WARNING") & ~F.col("status").isin("PASS", "N/A", "INFO"))


def verdict(card: DataFrame) -> DataFrame:
    """One row: RED with any blocker, else YELLOW with any warning, else GREEN."""
    failing = ~F.col("status").isin("PASS", "N/A", "INFO")

    def number(severity: str) -> Column:
        return F.count(F.when(failing & (F.col("severity") == severity), F.lit(1)))

    return card.agg(number("BLOCKER").alias("blockers"), number("WARNING").alias("warnings")).select(
        F.when(F.col("blockers") > 0, "RED").when(F.col("warnings") > 0, "YELLOW")
        .otherwise("GREEN").alias("verdict"), "blockers", "warnings")
