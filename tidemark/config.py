"""Datasets, keys, relations, thresholds and the personal-data inventory."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ENVIRONMENTS = ("dev", "staging", "prod")


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Columns of the landed datasets.
CUSTOMERS_SCHEMA = _strings(
    "customer_id", "full_name", "dob", "signup_date", "segment",
    "risk_band", "address", "kyc_status", "last_updated_ts",
)
MERCHANTS_SCHEMA = _strings(
    "merchant_id", "merchant_name", "mcc_code", "category",
    "country", "onboarding_date", "merchant_risk_score",
)
TRANSACTIONS_SCHEMA = _strings(
    "transaction_id", "card_id", "customer_id", "merchant_id", "txn_timestamp",
    "amount", "currency", "mcc_code", "channel", "txn_type", "status", "country",
    "is_fraud_flag", "txn_date",
)
DEVICE_LOGS_SCHEMA = T.StructType(
    list(_strings("session_id", "customer_id", "device_id", "event_type",
                  "event_timestamp", "ip_address").fields)
    + [
        T.StructField("geo", T.StructType([
            T.StructField("lat", T.DoubleType()),
            T.StructField("long", T.DoubleType()),
            T.StructField("city", T.StringType()),
            T.StructField("accuracy_m", T.DoubleType()),
        ])),
        T.StructField("device_meta", T.StructType([
            T.StructField("os", T.StringType()),
            T.StructField("app_version", T.StringType()),
            T.StructField("device_model", T.StringType()),
        ])),
    ]
)


@dataclass(frozen=True)
class IngestSpec:
    """One landing dataset: where its files are, how they look, what the raw table is called."""

    name: str
    fmt: str
    source: str
    table: str
    schema: T.StructType | None = None
    month_from_path: bool = False
    #: Column whose day the raw and typed tables are laid out by.
    day_from: str | None = None


@dataclass(frozen=True)
class Config:
    """Locations of one environment. Passed explicitly, so two environments never mix."""

    env: str
    landing_root: str
    lake_root: str
    max_files_per_batch: int = 1000
    specs: tuple[IngestSpec, ...] = field(default=())

    def __post_init__(self) -> None:
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"unsupported environment {self.env!r}; expected one of {ENVIRONMENTS}")
        if not self.specs:
            object.__setattr__(self, "specs", default_specs(self.landing_root))

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.lake_root}/{layer}/{table}"

    def checkpoint_path(self, spec: IngestSpec) -> str:
        return f"{self.lake_root}/checkpoints/{spec.name}"

    def schema_path(self, spec: IngestSpec) -> str:
        return f"{self.lake_root}/schemas/{spec.name}"


def default_specs(landing_root: str) -> tuple[IngestSpec, ...]:
    # Dataset folders and raw table names.
    return (
        IngestSpec("customers", "csv", f"{landing_root}/customers",
                   "bronze_customers_raw", CUSTOMERS_SCHEMA),
        IngestSpec("merchants", "csv", f"{landing_root}/merchants",
                   "bronze_merchants_raw", MERCHANTS_SCHEMA),
        IngestSpec("transactions", "csv", f"{landing_root}/transactions",
                   "bronze_transactions_raw", TRANSACTIONS_SCHEMA, month_from_path=True),
        IngestSpec("device_session_logs", "json", f"{landing_root}/device_session_logs",
                   "bronze_device_session_logs_raw", DEVICE_LOGS_SCHEMA, day_from="event_timestamp"),
    )


# Keys and relations of the datasets.
PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "merchants": ["merchant_id"],
    "transactions": ["transaction_id"],
    "device_session_logs": ["session_id"],
}


@dataclass(frozen=True)
class ForeignKey:
    child: str
    child_key: str
    parent: str
    parent_key: str

    @property
    def label(self) -> str:
        return f"{self.child}.{self.child_key} -> {self.parent}.{self.parent_key}"


# merchants.mcc_code is not unique: only existence checks may use that relation.
FOREIGN_KEYS = (
    ForeignKey("transactions", "customer_id", "customers", "customer_id"),
    ForeignKey("transactions", "merchant_id", "merchants", "merchant_id"),
    ForeignKey("transactions", "mcc_code", "merchants", "mcc_code"),
    ForeignKey("device_session_logs", "customer_id", "customers", "customer_id"),
)

# Baseline rates in percent.
DQ_THRESHOLDS = {
    "pre_signup_rate_pct": 20.41,
    "geo_velocity_anomaly_rate_pct": 0.39,
    "amount_outlier_rate_pct": 0.11,
    "orphan_rate_pct": 0.00,
}

# Physical and statistical limits.
MAX_SPEED_KMH = 900
EARTH_RADIUS_KM = 6371
OUTLIER_QUANTILE = 0.999
LOW_ACCURACY_M = 100

# Fixed values: (dataset, column, sensitivity).
PII_COLUMNS = (
    ("customers", "full_name", "High"),
    ("customers", "dob", "High"),
    ("customers", "address", "High"),
    ("customers", "customer_id", "Medium"),
    ("merchants", "merchant_name", "Low"),
    ("transactions", "customer_id", "Medium"),
    ("transactions", "card_id", "Medium"),
    ("device_session_logs", "ip_address", "High"),
    ("device_session_logs", "geo.lat", "High"),
    ("device_session_logs", "geo.long", "High"),
    ("device_session_logs", "geo.city", "Medium"),
    ("device_session_logs", "device_id", "Medium"),
    ("device_session_logs", "customer_id", "Medium"),
)

LABEL_CAVEAT = (
    "is_fraud_flag has unconfirmed provenance: it may be a confirmed outcome "
    "or the output of an amount rule"
)
