"""Fixed schemas, keys and declared limits of the star schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "smallint": T.ShortType(), "int": T.IntegerType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
    "decimal(12,2)": T.DecimalType(12, 2), "decimal(6,5)": T.DecimalType(6, 5),
    "bigint": T.LongType(), "decimal(18,1)": T.DecimalType(18, 1), "decimal(18,2)": T.DecimalType(18, 2),
    "decimal(18,3)": T.DecimalType(18, 3), "decimal(5,2)": T.DecimalType(5, 2), "decimal(6,4)": T.DecimalType(6, 4),
}


def _struct(spec: str) -> T.StructType:
    """Fields written as ``name type, name type``; needs no running session."""
    fields = [f.split(" ") for f in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


@dataclass(frozen=True)
class TableSpec:
    schema: T.StructType
    key: tuple[str, ...]
    file: str | None = None
    nullable: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    checks: dict[str, str] = field(default_factory=dict)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c for c in self.schema.names if c not in self.nullable)

    @property
    def decimals(self) -> dict[str, T.DecimalType]:
        return {f.name: f.dataType for f in self.schema if isinstance(f.dataType, T.DecimalType)}


# Base tables, parents before children.
STAR = {
    "dim_customer": TableSpec(
        schema=_struct(
            "customer_id string, home_city string, home_state string, home_latitude double, "
            "home_longitude double, age smallint, customer_segment string, signup_date date"
        ),
        key=("customer_id",),
        file="customers.csv",
        lengths={"customer_id": 10, "home_city": 50, "home_state": 2, "customer_segment": 20},
    ),
    "dim_device": TableSpec(
        schema=_struct(
            "device_id string, customer_id string, device_type string, first_seen_at timestamp, is_trusted boolean"
        ),
        key=("device_id",),
        file="devices.csv",
        lengths={"device_id": 10, "customer_id": 10, "device_type": 20},
        foreign={"customer_id": ("dim_customer", "customer_id")},
    ),
    "fact_transaction": TableSpec(
        schema=_struct(
            "transaction_id string, customer_id string, device_id string, txn_timestamp timestamp, "
            "amount decimal(12,2), merchant_category string, channel string, city string, state string, "
            "latitude double, longitude double, is_fraud boolean, fraud_scenario string"
        ),
        key=("transaction_id",),
        file="transactions.csv",
        nullable=("fraud_scenario",),
        lengths={
            "transaction_id": 12, "customer_id": 10, "device_id": 10, "merchant_category": 30,
            "channel": 10, "city": 50, "state": 2, "fraud_scenario": 30,
        },
        foreign={
            "customer_id": ("dim_customer", "customer_id"),
            "device_id": ("dim_device", "device_id"),
        },
        checks={"amount_positive": "amount > 0", "channel_known": "channel IN ('online', 'in_store')"},
    ),
}

FEATURES = TableSpec(
    schema=_struct(
        "transaction_id string, customer_id string, txn_timestamp timestamp, amount decimal(12,2), "
        "merchant_category string, channel string, customer_txn_seq bigint, "
        "avg_amount_7d decimal(18,2), avg_amount_30d decimal(18,2), "
        "amount_to_avg_7d_ratio decimal(18,3), amount_to_avg_30d_ratio decimal(18,3), "
        "txn_count_1h bigint, txn_count_24h bigint, amount_sum_1h decimal(18,2), amount_sum_24h decimal(18,2), "
        "minutes_since_prev_txn decimal(18,1), km_from_prev_txn decimal(18,1), geo_velocity_kmh decimal(18,1), "
        "km_from_home decimal(18,1), device_age_hours decimal(18,2), hour_of_day smallint, day_of_week smallint, "
        "is_night boolean, is_online boolean, is_fraud boolean"
    ),
    key=("transaction_id",),
    # A customer's first transaction has no history.
    nullable=(
        "avg_amount_7d", "avg_amount_30d", "amount_to_avg_7d_ratio", "amount_to_avg_30d_ratio",
        "minutes_since_prev_txn", "km_from_prev_txn", "geo_velocity_kmh",
    ),
)

SCORES = TableSpec(
    schema=_struct(
        "transaction_id string, model_version string, scored_at timestamp, dataset_split string, "
        "xgb_fraud_probability decimal(6,5), isolation_anomaly_score decimal(5,2), "
        "anomaly_risk_score smallint, risk_tier string, is_flagged boolean"
    ),
    key=("transaction_id",),
    lengths={"transaction_id": 12, "model_version": 10, "dataset_split": 5, "risk_tier": 8},
    foreign={"transaction_id": ("fact_transaction", "transaction_id")},
)

MODEL_PERFORMANCE = TableSpec(
    schema=_struct(
        "model string, sort_order smallint, roc_auc decimal(6,4), pr_auc decimal(6,4), flagged_txns int, "
        "precision_rate decimal(6,4), recall_rate decimal(6,4), false_positive_rate decimal(6,4), "
        "fraud_dollars decimal(12,2), fraud_dollars_caught decimal(12,2), dollar_recall decimal(6,4)"
    ),
    key=("model",),
    nullable=(
        "sort_order", "roc_auc", "pr_auc", "flagged_txns", "precision_rate", "recall_rate", "false_positive_rate",
        "fraud_dollars", "fraud_dollars_caught", "dollar_recall",
    ),
    lengths={"model": 30},
)

SCENARIO_RECALL = TableSpec(
    schema=_struct("model string, sort_order smallint, fraud_type string, recall_rate decimal(6,4)"),
    key=("model", "fraud_type"),
    nullable=("sort_order", "recall_rate"),
    lengths={"model": 30, "fraud_type": 30},
)

# The ten merchant categories, in their declared order (fixed values).
MERCHANT_CATEGORIES = (
    "grocery", "restaurants", "gas", "retail", "entertainment",
    "electronics", "utilities", "health", "travel", "gift_cards",
)
