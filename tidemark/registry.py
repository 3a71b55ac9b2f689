"""Every operator as a named query over the test tables.

Results leave through :func:`portable`, which reduces them to bigint, double, boolean and string
columns so that any SQL engine can be compared with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config
from tidemark.functions import calendar, masks
from tidemark.operators import (
    distribution, integrity, lifecycle, nested, pii, profile, quantiles, thresholds, timeline, velocity,
)
from tidemark.plans import gold, roles, scd2, scorecard, silver
from tidemark.session import scratch_path
from tidemark.sources import landing, tables
from tidemark.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def today():
    return F.lit(roles.TODAY).cast("date")


def portable(df: DataFrame) -> DataFrame:
    """Plain column types: integers as bigint, decimals as double, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        out.append(col.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    """Registers a function under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


# ---- profiling -------------------------------------------------------------------------------

@query
def profile_counts(spark, d):
    return profile.profile(roles.transactions(spark, d), ["transaction_id"])


@query
def profile_lineitem(spark, d):
    return profile.profile(roles.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def profile_sessions(spark, d):
    return profile.profile(roles.device_session_logs(spark, d), ["customer_id"])


@query
def null_counts(spark, d):
    return profile.null_counts(roles.transactions(spark, d))


@query
def pk_duplicates(spark, d):
    return profile.duplicate_keys(roles.read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def cast_validation(spark, d):
    return profile.validate_casts(roles.transactions_landed(spark, d), [
        ("txn_timestamp", "timestamp"), ("amount", "double"), ("mcc_code", "int"),
        ("is_fraud_flag", "boolean"), ("txn_date", "date")])


@query
def cast_validation_customers(spark, d):
    return profile.validate_casts(roles.customers_landed(spark, d), [
        ("dob", "date"), ("signup_date", "date"), ("last_updated_ts", "timestamp")])


@query
def cardinality_transactions(spark, d):
    return profile.cardinality(
        roles.transactions(spark, d), ["transaction_id", "card_id", "customer_id", "merchant_id"])


@query
def cardinality_sessions(spark, d):
    return profile.cardinality(
        roles.device_session_logs(spark, d), ["session_id", "device_id", "customer_id"])


@query
def cardinality_lineitem(spark, d):
    return profile.cardinality(roles.read(spark, d, "lineitem"), ["l_orderkey", "l_suppkey", "l_partkey"])


# ---- referential integrity -------------------------------------------------------------------

@query
def orphan_rate(spark, d):
    return integrity.integrity_checks(roles.all_tables(spark, d), roles.FOREIGN_KEYS)


@query
def orphan_rate_lineitem(spark, d):
    items = roles.read(spark, d, "lineitem")
    parents = {
        "orders": (roles.read(spark, d, "orders").where("o_orderkey % 13 <> 0"), "l_orderkey", "o_orderkey"),
        "supplier": (roles.read(spark, d, "supplier"), "l_suppkey", "s_suppkey"),
        "part": (roles.read(spark, d, "part"), "l_partkey", "p_partkey"),
    }
    checks = [integrity.integrity_check(items, ck, parent, pk, f"lineitem.{ck} -> {name}.{pk}")
              for name, (parent, ck, pk) in parents.items()]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query
def orphan_rows(spark, d):
    return integrity.orphan_rows(
        roles.transactions(spark, d), "customer_id", roles.customers_incomplete(spark, d), "customer_id"
    ).select("transaction_id", "customer_id", "amount")


@query
def null_fk_rows(spark, d):
    return roles.transactions(spark, d).where(F.col("customer_id").isNull()).select(
        "transaction_id", "merchant_id", "txn_date")


# ---- distributions ---------------------------------------------------------------------------

@query
def amount_stats(spark, d):
    return distribution.amount_stats(roles.transactions(spark, d), "amount")


@query
def amount_quantiles(spark, d):
    q = quantiles.exact_quantiles(roles.transactions(spark, d), "amount", ["0.001", "0.5", "0.95", "0.99", "0.999"])
    return q.select(F.col("p").cast("double").alias("p"), "value", "above")


@query
def lineitem_price_quantiles(spark, d):
    q = quantiles.exact_quantiles(roles.read(spark, d, "lineitem"), "l_extendedprice", ["0.5", "0.999"])
    return q.select(F.col("p").cast("double").alias("p"), "value", "above")


@query
def top_codes(spark, d):
    t = distribution.top_values(roles.transactions(spark, d), "mcc_code").withColumn("source", F.lit("transactions"))
    m = distribution.top_values(roles.merchants(spark, d), "mcc_code").withColumn("source", F.lit("merchants"))
    return t.unionByName(m)


@query
def channel_share(spark, d):
    return distribution.breakdown(roles.transactions(spark, d), "channel", 6)


@query
def status_share(spark, d):
    return distribution.breakdown(roles.transactions(spark, d), "status", 6)


@query
def label_share(spark, d):
    return distribution.breakdown(roles.transactions(spark, d), "is_fraud_flag", 6)


@query
def label_rate(spark, d):
    return distribution.rate_vs_target(roles.transactions(spark, d), F.col("is_fraud_flag"), 0.018)


@query
def dirty_counts(spark, d):
    return distribution.dirty_counts(roles.transactions(spark, d), "customer_id", "amount")


@query
def heavy_share(spark, d):
    return distribution.heavy_share(roles.read(spark, d, "events"), "user_id")


@query
def heavy_share_transactions(spark, d):
    return distribution.heavy_share(roles.transactions(spark, d), "customer_id")


# ---- time ------------------------------------------------------------------------------------

@query
def time_ranges(spark, d):
    return timeline.time_ranges([
        ("transactions", roles.transactions(spark, d), ["txn_timestamp", "txn_date"]),
        ("customers", roles.customers(spark, d), ["signup_date", "dob", "last_updated_ts"]),
        ("merchants", roles.merchants(spark, d), ["onboarding_date"]),
        ("device_session_logs", roles.device_session_logs(spark, d), ["event_timestamp"]),
    ])


@query
def future_dated(spark, d):
    return timeline.future_dated(roles.transactions(spark, d), "txn_timestamp", today())


@query
def daily_volume(spark, d):
    return timeline.daily_volume(roles.transactions(spark, d), "txn_timestamp")


@query
def gap_days(spark, d):
    return timeline.gap_days(timeline.daily_volume(roles.transactions(spark, d), "txn_timestamp"))


@query
def age_sanity(spark, d):
    return timeline.age_sanity(roles.customers(spark, d), F.col("dob"), today())


@query
def txn_calendar_cols(spark, d):
    return calendar.with_calendar(
        roles.transactions(spark, d).select("transaction_id", "txn_timestamp"), "txn_timestamp"
    ).groupBy("txn_date", "txn_year", "txn_month").agg(F.count(F.lit(1)).alias("n"))


@query
def partition_month(spark, d):
    """Each landing layout on a third of the rows, and one that matches none."""
    day = F.col("txn_timestamp")
    path = (
        F.when(F.col("transaction_id") % 4 == 0,
               F.concat(F.lit("/lake/transactions/"), F.date_format(day, "yyyy/MM"), F.lit("/data.csv")))
        .when(F.col("transaction_id") % 4 == 1,
              F.concat(F.lit("/lake/transactions/txn_year="), F.date_format(day, "yyyy"),
                       F.lit("/txn_month="), F.date_format(day, "MM"), F.lit("/part-0.csv")))
        .when(F.col("transaction_id") % 4 == 2,
              F.concat(F.lit("/lake/transactions/daily/txn_date="), F.date_format(day, "yyyy-MM-dd"),
                       F.lit("/part-0.csv")))
        .otherwise(F.lit("/lake/transactions/full/part-0.csv"))
    )
    return roles.transactions(spark, d).select(
        calendar.partition_month(path).alias("partition_month")).groupBy("partition_month").agg(
        F.count(F.lit(1)).alias("n"))


@query
def first_seen(spark, d):
    return timeline.first_seen(roles.lines(spark, d), "transaction_id", F.col("txn_date"))


# ---- nested columns --------------------------------------------------------------------------

@query
def flatten_events(spark, d):
    return nested.flatten_structs(roles.device_session_logs(spark, d), roles.GEO_FIELDS)


@query
def nested_nulls(spark, d):
    return nested.nested_nulls(roles.device_session_logs(spark, d), roles.GEO_FIELDS)


@query
def geo_range_violations(spark, d):
    return nested.geo_range(roles.device_session_logs(spark, d))


@query
def schema_drift(spark, d):
    flat = nested.flatten_structs(roles.device_session_logs(spark, d), roles.GEO_FIELDS)
    fields = [leaf for leaves in roles.GEO_FIELDS.values() for leaf in leaves]
    return nested.schema_drift(flat, ["event_timestamp", "session_id"], fields, 100)


@query
def edge_samples(spark, d):
    return nested.edge_samples(
        roles.device_session_logs(spark, d).select("event_timestamp", "session_id"),
        ["event_timestamp", "session_id"], 25)


# ---- outliers --------------------------------------------------------------------------------

def _outliers(spark, d):
    return distribution.amount_outliers(roles.transactions(spark, d), "amount")


@query
def amount_outliers(spark, d):
    return _outliers(spark, d).select("transaction_id", "customer_id", "merchant_id", "amount",
                                      "txn_timestamp", "status", "is_fraud_flag")


@query
def outliers_largest(spark, d):
    return _outliers(spark, d).select("transaction_id", "amount", "channel", "status").orderBy(
        F.desc("amount"), "transaction_id").limit(30)


def _wide_outliers(spark, d):
    return distribution.amount_outliers(roles.transactions(spark, d), "amount", 0.95)


@query
def outlier_by_txn_type(spark, d):
    return distribution.outlier_breakdown(_wide_outliers(spark, d), "txn_type", "amount")


@query
def outlier_by_channel(spark, d):
    return distribution.outlier_breakdown(_wide_outliers(spark, d), "channel", "amount")


@query
def outlier_by_currency(spark, d):
    return distribution.outlier_breakdown(_wide_outliers(spark, d), "currency", "amount")


@query
def outlier_currency_share(spark, d):
    return distribution.breakdown(_wide_outliers(spark, d), "currency", 6)


@query
def round_amounts(spark, d):
    rounded = roles.transactions(spark, d).withColumn("amount", F.floor(F.col("amount") / 50) * 50.0)
    return distribution.round_amounts(distribution.amount_outliers(rounded, "amount", 0.9), "amount")


# ---- geographic velocity ---------------------------------------------------------------------

def _fixes(spark, d, dirty=False):
    return nested.flatten_structs(roles.device_session_logs(spark, d, dirty), roles.GEO_FIELDS)


def _pairs(spark, d, prev_cols=(), dirty=False):
    return velocity.velocity_pairs(_fixes(spark, d, dirty), "customer_id", "event_timestamp", "session_id",
                                   "lat", "long", prev_cols)


@query
def velocity_pairs(spark, d):
    return _pairs(spark, d, ["accuracy_m", "app_version", "os"]).select(
        "customer_id", "session_id", "event_timestamp", "lat", "long", "accuracy_m", "app_version", "os",
        F.col("prev.event_timestamp").alias("prev_ts"),
        F.col("prev.lat").alias("prev_lat"), F.col("prev.long").alias("prev_long"),
        F.col("prev.accuracy_m").alias("prev_accuracy_m"),
        F.col("prev.app_version").alias("prev_app_version"), F.col("prev.os").alias("prev_os"),
        F.round("dist_km", 3).alias("dist_km"), F.round("time_hours", 6).alias("time_hours"), "speed_kmh")


@query
def velocity_impossible(spark, d):
    return velocity.impossible(_pairs(spark, d, dirty=True)).select("customer_id", "session_id", "speed_kmh")


@query
def velocity_worst(spark, d):
    return velocity.impossible(_pairs(spark, d)).select(
        "customer_id", "session_id", "speed_kmh").orderBy(F.desc("speed_kmh"), "session_id").limit(20)


@query
def accuracy_stats(spark, d):
    return velocity.accuracy_stats(velocity.impossible(_pairs(spark, d)))


@query
def pairs_by_app_version(spark, d):
    return velocity.pair_concentration(velocity.impossible(_pairs(spark, d)), "app_version", "customer_id")


@query
def pairs_by_os(spark, d):
    return velocity.pair_concentration(velocity.impossible(_pairs(spark, d)), "os", "customer_id")


@query
def pairs_top_customers(spark, d):
    return velocity.pair_concentration(
        velocity.impossible(_pairs(spark, d)), "customer_id", "customer_id", 20).drop("distinct_keys")


@query
def pairs_top_devices(spark, d):
    return velocity.pair_concentration(
        velocity.impossible(_pairs(spark, d)), "device_id", "customer_id", 20).drop("distinct_keys")


@query
def label_rate_by_flag(spark, d):
    return distribution.label_rate_by_flag(
        roles.transactions(spark, d), "customer_id", F.col("is_fraud_flag"),
        velocity.impossible(_pairs(spark, d)))


@query
def geo_flags(spark, d):
    return velocity.flag_geo(_fixes(spark, d, True), "customer_id", "event_timestamp", "session_id",
                             "lat", "long", "accuracy_m").select(
        "session_id", "customer_id", "speed_kmh",
        "is_geo_velocity_anomaly", "is_geo_low_accuracy", "is_geo_accuracy_missing")


# ---- lifecycle -------------------------------------------------------------------------------

def _early(spark, d):
    return lifecycle.pre_lifecycle(
        roles.transactions(spark, d), roles.customers(spark, d), "customer_id",
        F.col("txn_date"), F.col("signup_date"), ["transaction_id"],
        ["segment", "risk_band", "kyc_status", "last_updated_ts"])


def _early_lines(spark, d):
    orders = roles.read(spark, d, "orders").withColumnRenamed("o_orderkey", "transaction_id")
    return lifecycle.pre_lifecycle(
        roles.lines(spark, d), orders, "transaction_id", F.col("txn_date"),
        F.col("o_orderdate").cast("date"), ["merchant_id"], ["o_orderpriority"])


@query
def pre_lifecycle_rows(spark, d):
    return _early_lines(spark, d).agg(F.count(F.lit(1)).alias("pre_lifecycle_rows"))


@query
def lifecycle_summary(spark, d):
    return lifecycle.affected_summary(_early(spark, d), "customer_id")


@query
def lifecycle_worst(spark, d):
    return _early(spark, d).select(
        "customer_id", "transaction_id", "parent_date", "child_date", "days_before",
        "segment", "risk_band", "kyc_status", "last_updated_ts",
    ).orderBy(F.desc("days_before"), "transaction_id").limit(30)


@query
def concentration_by_segment(spark, d):
    return lifecycle.concentration(_early(spark, d), "segment", "customer_id", roles.customers(spark, d))


@query
def concentration_by_risk_band(spark, d):
    return lifecycle.concentration(_early(spark, d), "risk_band", "customer_id", roles.customers(spark, d))


@query
def concentration_by_kyc(spark, d):
    return lifecycle.concentration(_early(spark, d), "kyc_status", "customer_id")


@query
def concentration_by_priority(spark, d):
    return lifecycle.concentration(_early_lines(spark, d), "o_orderpriority", "transaction_id",
                                   roles.read(spark, d, "orders"))


@query
def lifecycle_gap_stats(spark, d):
    return lifecycle.gap_stats(_early_lines(spark, d))


@query
def gap_buckets(spark, d):
    return lifecycle.gap_buckets(_early(spark, d))


def _overwrites(spark, d):
    firsts = timeline.first_seen(
        roles.transactions(spark, d).where("customer_id IS NOT NULL"), "customer_id", F.col("txn_date"))
    return lifecycle.overwrite_check(
        roles.customers(spark, d), firsts, "customer_id", F.col("signup_date"), F.col("last_updated_ts"))


@query
def overwrite_stats(spark, d):
    return lifecycle.overwrite_stats(_overwrites(spark, d))


@query
def overwrite_worst(spark, d):
    return _overwrites(spark, d).where("updated_after").orderBy(
        F.desc("days_after"), "customer_id").limit(20)


# ---- personal data ---------------------------------------------------------------------------

@query
def pii_inventory(spark, d):
    return pii.pii_inventory(roles.all_tables(spark, d))


@query
def pii_totals(spark, d):
    return pii.pii_totals(pii.pii_inventory(roles.all_tables(spark, d)))


def _levels(dataset):
    return {c: s for t, c, s in config.PII_COLUMNS if t == dataset}


@query
def mask_customer(spark, d):
    return masks.mask_pii(roles.customers(spark, d), _levels("customers")).select(
        "customer_id", "full_name", "dob", "address", "segment", "signup_date")


@query
def mask_sessions(spark, d):
    masked = masks.mask_pii(roles.device_session_logs(spark, d), _levels("device_session_logs"))
    return masked.select("session_id", "customer_id", "device_id", "ip_address",
                         F.col("geo.lat").alias("lat"), F.col("geo.city").alias("city"),
                         F.col("geo.accuracy_m").alias("accuracy_m"))


# ---- scorecard -------------------------------------------------------------------------------

def _card(spark, d):
    return scorecard.scorecard(roles.all_tables(spark, d), today(), roles.FOREIGN_KEYS)


@query
def scorecard_lines(spark, d):
    return _card(spark, d)


@query
def scorecard_findings(spark, d):
    return scorecard.findings(_card(spark, d)).select("check_name", "subject", "value", "status", "severity")


@query
def verdict(spark, d):
    return scorecard.verdict(_card(spark, d))


@query
def threshold_regression(spark, d):
    """Observed rates of the four watched metrics against their baselines."""
    tables = roles.all_tables(spark, d)
    txns = tables["transactions"].agg(F.count(F.lit(1)).alias("total"))
    logs = tables["device_session_logs"].agg(F.count(F.lit(1)).alias("total"))

    def rate(metric, rows, total):
        return rows.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(metric).alias("metric"), F.round(F.col("n") / total.scalar() * 100, 4).alias("observed"))

    orphans = integrity.integrity_check(
        tables["transactions"], "customer_id", tables["customers_incomplete"], "customer_id", "").select(
        F.lit("orphan_rate_pct").alias("metric"), F.col("orphan_pct").alias("observed"))
    observed = (
        rate("pre_signup_rate_pct", _early(spark, d), txns)
        .unionByName(rate("geo_velocity_anomaly_rate_pct", velocity.impossible(_pairs(spark, d, dirty=True)), logs))
        .unionByName(rate("amount_outlier_rate_pct", _outliers(spark, d), txns))
        .unionByName(orphans)
    )
    return thresholds.threshold_check(observed, tolerance=0.05)


# ---- refined layers --------------------------------------------------------------------------

@query
def silver_transactions(spark, d):
    return silver.silver_transactions(roles.transactions_landed(spark, d)).select(
        "transaction_id", "customer_id", "txn_timestamp", "amount", "mcc_code", "is_fraud_flag", "txn_date",
        "is_negative_amount")


@query
def silver_customers(spark, d):
    return silver.silver_customers(roles.customers_landed(spark, d)).select(
        "customer_id", "dob", "signup_date", "segment", "last_updated_ts")


@query
def silver_merchants(spark, d):
    return silver.silver_merchants(roles.merchants_landed(spark, d))


def _sessions_landed(spark, d):
    return roles.device_session_logs(spark, d).withColumns({
        "event_timestamp": F.when(F.col("session_id") % 71 == 0, "late").otherwise(
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss")),
        "customer_id": F.when(F.col("session_id") % 73 != 0, F.col("customer_id").cast("string")),
        "session_id": F.col("session_id").cast("string"),
    })


@query
def silver_sessions(spark, d):
    return silver.silver_device_session_logs(_sessions_landed(spark, d)).select(
        "session_id", "customer_id", "event_timestamp", F.col("geo.lat").alias("lat"))


@query
def quarantine_sessions(spark, d):
    return silver.split_quarantine(_sessions_landed(spark, d), "device_session_logs")[1].select(
        "session_id", "customer_id", "event_timestamp", "reject_reasons")


@query
def quarantine_transactions(spark, d):
    return silver.split_quarantine(roles.transactions_landed(spark, d), "transactions")[1].select(
        "transaction_id", "customer_id", "amount", "txn_date", "reject_reasons")


@query
def quarantine_customers(spark, d):
    return silver.split_quarantine(roles.customers_landed(spark, d), "customers")[1].select(
        "full_name", "dob", "signup_date", "reject_reasons")


def _enriched(spark, d, customers=roles.customers):
    return silver.enrich_transactions(roles.transactions(spark, d), customers(spark, d), roles.merchants(spark, d))


@query
def silver_enriched(spark, d):
    return _enriched(spark, d, roles.customers_incomplete).select(
        "transaction_id", "customer_id", "segment", "risk_band", "merchant_name", "category",
        "is_amount_outlier", "is_negative_amount", "is_signup_date_suspect",
        "is_orphan_customer", "is_orphan_merchant", "is_unknown_mcc")


@query
def silver_sessions_enriched(spark, d):
    return silver.enrich_sessions(
        roles.device_session_logs(spark, d), roles.customers_incomplete(spark, d)).select(
        "session_id", "customer_id", "segment", "risk_band", "is_orphan_customer")


@query
def signup_suspects(spark, d):
    return silver.flag_signup_suspect(roles.customers(spark, d), roles.transactions(spark, d)).select(
        "customer_id", "signup_date", "is_signup_date_suspect")


@query
def scd2_history(spark, d):
    return scd2.scd2(roles.read(spark, d, "events"), "user_id", ["event_type"], "ts", "event_id")


@query
def scd2_merged(spark, d):
    """The history built in two batches equals the history built at once."""
    events = roles.read(spark, d, "events")
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    path = scratch_path(spark, "scd2")
    apply = scd2.merge_batch(path, "user_id", ["event_type"], "ts")
    apply(events.where(F.col("ts") < cut), 0)
    apply(events.where(F.col("ts") >= cut), 1)
    return scd2.current_version(spark, path)


@query
def scd2_merged_late(spark, d):
    """Batches cut across time, so that most of their rows are late: the same history again."""
    events = roles.read(spark, d, "events")
    path = scratch_path(spark, "scd2")
    apply = scd2.merge_batch(path, "user_id", ["event_type"], "ts", "event_id")
    for batch in range(3):
        apply(events.where(F.col("event_id") % 3 == batch), batch)
    return scd2.current_version(spark, path)


def _customer_history(spark, d):
    """Two observations per customer: everyone was pending thirty days before the last update."""
    observed = roles.customers(spark, d).select(
        "customer_id", "full_name", "segment", "risk_band", "kyc_status", "nation_key", "last_updated_ts")
    earlier = observed.withColumns({
        "kyc_status": F.lit("pending"), "last_updated_ts": F.col("last_updated_ts") - F.expr("interval 30 days")})
    return scd2.scd2(earlier.unionByName(observed), "customer_id",
                     ["full_name", "segment", "risk_band", "kyc_status", "nation_key"], "last_updated_ts")


@query
def dim_customer(spark, d):
    nation, region = roles.read(spark, d, "nation"), roles.read(spark, d, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    return gold.dim_customer(_customer_history(spark, d)).join(places, "nation_key", "left").drop("nation_key")


@query
def dim_merchant(spark, d):
    return gold.dim_merchant(roles.merchants(spark, d))


@query
def dim_date(spark, d):
    return gold.dim_date(roles.transactions(spark, d), "txn_date")


@query
def fact_transactions(spark, d):
    return gold.fact_transactions(_enriched(spark, d))


@query
def daily_fraud_summary(spark, d):
    return gold.daily_fraud_summary(gold.fact_transactions(_enriched(spark, d)))


@query
def customer_risk_scorecard(spark, d):
    return gold.customer_risk_scorecard(
        roles.customers(spark, d), gold.fact_transactions(_enriched(spark, d)))


@query
def merchant_performance_daily(spark, d):
    return gold.merchant_performance_daily(roles.lines(spark, d))


@query
def channel_volume_trends(spark, d):
    return gold.channel_volume_trends(gold.fact_transactions(_enriched(spark, d)))


# ---- landing files and raw tables ------------------------------------------------------------
# These write below the shared folder first, because ingestion is about files.

_RUN = "registry-run"


def _land(spark, d, root, names):
    """Datasets as landing files."""
    if "customers" in names:
        landing.write_csv(roles.customers_landed(spark, d), f"{root}/customers/full_load")
    if "merchants" in names:
        landing.write_csv(roles.merchants_landed(spark, d), f"{root}/merchants/full_load")
    if "transactions" in names:
        # Every row brings the time by which its file is laid out: the landed text may not be one.
        txns = roles.transactions_landed(spark, d, "txn_timestamp AS _at").withColumnRenamed("txn_date", "_txn_date")
        (calendar.with_calendar(txns, "_at").drop("txn_date", "_at").withColumnRenamed("_txn_date", "txn_date")
         .hint("rebalance", "txn_year", "txn_month").write.option("header", True)
         .partitionBy("txn_year", "txn_month").csv(f"{root}/transactions"))
    if "device_session_logs" in names:
        sessions = roles.device_session_logs(spark, d).withColumns({
            "session_id": F.col("session_id").cast("string"), "customer_id": F.col("customer_id").cast("string")})
        landing.write_daily_json(sessions, "event_timestamp", f"{root}/device_session_logs")


def _ingested(spark, d, *names):
    """(configuration, status, raw table of the last named dataset) after landing and ingesting."""
    root = scratch_path(spark, "lake")
    specs = tuple(s for s in config.default_specs(f"{root}/landing") if s.name in names)
    cfg = config.Config("dev", f"{root}/landing", f"{root}/lake", specs=specs)
    _land(spark, d, cfg.landing_root, names)
    status = ingest.ingest_all(spark, cfg, _RUN)
    return cfg, status, ingest.bronze(spark, specs[-1], cfg)


@query
def scan_csv_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    landing.write_partitioned_csv(
        roles.transactions(spark, d).select("transaction_id", "customer_id", "channel", "txn_timestamp"),
        "txn_timestamp", path)
    return landing.read_landing_csv(spark, path).select("transaction_id", "customer_id", "channel", "txn_date")


@query
def scan_json_roundtrip(spark, d):
    path = scratch_path(spark, "json")
    sessions = roles.device_session_logs(spark, d).withColumns({
        "session_id": F.col("session_id").cast("string"), "customer_id": F.col("customer_id").cast("string")})
    landing.write_daily_json(sessions, "event_timestamp", path)
    read = landing.read_landing_json(spark, path, config.DEVICE_LOGS_SCHEMA)
    return nested.flatten_structs(read.drop("event_timestamp"), roles.GEO_FIELDS)


@query
def ingest_status(spark, d):
    cfg, status, _ = _ingested(spark, d, "customers", "merchants", "transactions", "device_session_logs")
    counts = [ingest.bronze(spark, spec, cfg).agg(F.count(F.lit(1)).alias("total_rows")).select(
        F.lit(spec.name).alias("dataset"), "total_rows") for spec in cfg.specs]
    total = counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
    return status.join(total, "dataset").select("dataset", "status", "total_rows")


@query
def ingest_transactions(spark, d):
    _, _, raw = _ingested(spark, d, "transactions")
    return raw.select(
        "transaction_id", "customer_id", "amount", "txn_date", "_partition_date", "_pipeline_run_id",
        "_rescued_data")


@query
def ingest_sessions(spark, d):
    _, _, raw = _ingested(spark, d, "device_session_logs")
    return nested.flatten_structs(raw, roles.GEO_FIELDS).select(
        "session_id", "customer_id", "lat", "long", "city", "accuracy_m", "os", "app_version",
        "_rescued_data")


@query
def ingest_rescued(spark, d):
    """Three kinds of files: as declared, with an unknown column and others reordered, with a field too many on some lines."""
    root = scratch_path(spark, "lake")
    spec = next(s for s in config.default_specs(f"{root}/landing") if s.name == "customers")
    cfg = config.Config("dev", f"{root}/landing", f"{root}/lake", specs=(spec,))
    names = config.CUSTOMERS_SCHEMA.fieldNames()
    rows = roles.customers(spark, d).withColumn("k", F.col("customer_id"))
    rows = rows.select("k", *[F.col(c).cast("string").alias(c) for c in names if c != "last_updated_ts"],
                       F.date_format("last_updated_ts", "yyyy-MM-dd HH:mm:ss").alias("last_updated_ts"))
    rows.where("k % 3 = 0").select(names).write.option("header", True).csv(f"{spec.source}/full_load/plain")
    vip = F.when(F.col("k") % 5 == 0, F.lit("yes")).alias("vip")
    rows.where("k % 3 = 1").select(*names[::-1][:4], vip, *names[::-1][4:]).write.option("header", True).csv(f"{spec.source}/full_load/extra")
    line = F.concat_ws(",", *names, F.when(F.col("k") % 7 == 0, F.lit("one more")))
    # Lines are written as they are: the separator of this writer occurs in none of them.
    (rows.where("k % 3 = 2").select(line.alias(",".join(names))).write.option("header", True).option("sep", "\u0001")
     .csv(f"{spec.source}/full_load/ragged"))
    ingest.ingest(spark, spec, cfg, _RUN)
    return ingest.bronze(spark, spec, cfg).select(*names, "_rescued_data")


@query
def ingest_schema_memory(spark, d):
    """A schema inferred from the first drop holds for the second: its new column is rescued, not added."""
    root = scratch_path(spark, "lake")
    spec = config.IngestSpec("merchants", "csv", f"{root}/landing/merchants", "bronze_merchants_raw")
    cfg = config.Config("dev", f"{root}/landing", f"{root}/lake", specs=(spec,))
    rows = roles.merchants(spark, d).select("merchant_id", "merchant_name", "category")
    even = F.col("merchant_id") % 2 == 0
    landing.write_csv(rows.where(even), f"{spec.source}/first")
    ingest.ingest(spark, spec, cfg, "first")
    landing.write_csv(rows.where(~even).select(F.lit("yes").alias("vip"), "*"), f"{spec.source}/second")
    ingest.ingest(spark, spec, cfg, "second")
    return ingest.bronze(spark, spec, cfg).select("merchant_id", "merchant_name", "category", "_rescued_data", "_pipeline_run_id")


@query
def audit_cols(spark, d):
    """Rows per run with how many carry a file name and an ingestion time."""
    _, _, raw = _ingested(spark, d, "customers")
    return raw.groupBy("_pipeline_run_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_source_file").endswith(".csv")).alias("with_file"),
        F.count("_ingested_at").alias("with_time"))


@query
def table_roundtrip(spark, d):
    """A managed table written twice: the second write replaces rows and columns of the first."""
    name, path = f"tidemark_{uuid.uuid4().hex[:8]}.merchants", scratch_path(spark, "database")
    tables.write_table(roles.merchants(spark, d), name, database_path=path)
    tables.write_table(gold.dim_merchant(roles.merchants(spark, d)), name)
    return tables.read_table(spark, name)
