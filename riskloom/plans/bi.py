"""Reporting star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.labels import (
    age_band, channel_label, model_period, outcome, score_band, tier_order, title,
)
from riskloom.operators.calendar import date_spine, dim_date, span

RISK_DRIVERS = (
    "txn_count_1h", "amount_to_avg_30d_ratio", "geo_velocity_kmh", "km_from_home", "device_age_hours",
)


def bi_fact(fact: DataFrame, scores: DataFrame, features: DataFrame, devices: DataFrame) -> DataFrame:
    """One row per transaction, scored and labelled. One partitioning on the
    transaction serves all joins; only the two id columns also travel by device."""
    used = fact.select("transaction_id", "device_id").join(devices.select("device_id", "device_type"), "device_id")
    rows = (
        fact.join(scores, "transaction_id")
        .join(features.select("transaction_id", *RISK_DRIVERS), "transaction_id")
        .join(used.select("transaction_id", "device_type"), "transaction_id")
    )
    ts, score = F.col("txn_timestamp"), F.col("anomaly_risk_score")
    return rows.select(
        "transaction_id",
        "customer_id",
        "device_id",
        "txn_timestamp",
        F.to_date(ts).alias("txn_date"),
        F.hour(ts).cast("smallint").alias("txn_hour"),
        "amount",
        title(F.col("merchant_category")).alias("merchant_category"),
        channel_label(F.col("channel")).alias("channel"),
        "city",
        "state",
        "latitude",
        "longitude",
        title(F.col("device_type")).alias("device_type"),
        "is_fraud",
        F.coalesce(title(F.col("fraud_scenario")), F.lit("Legitimate")).alias("fraud_type"),
        "anomaly_risk_score",
        "risk_tier",
        tier_order(F.col("risk_tier")).alias("risk_tier_order"),
        score_band(score).alias("score_band"),
        "xgb_fraud_probability",
        "isolation_anomaly_score",
        "is_flagged",
        outcome(F.col("is_flagged"), F.col("is_fraud")).alias("outcome"),
        model_period(F.col("dataset_split")).alias("model_period"),
        "model_version",
        *RISK_DRIVERS,
    )


def bi_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "home_city",
        "home_state",
        F.initcap("customer_segment").alias("customer_segment"),
        "age",
        age_band(F.col("age")).alias("age_band"),
        "signup_date",
    )


def bi_date(fact: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Calendar between two days, by default those of the first and last transaction."""
    ends = span(fact, "txn_timestamp")
    first = F.col("first_day") if start is None else F.lit(start)
    last = F.col("last_day") if end is None else F.lit(end)
    return dim_date(date_spine(ends, first, last))


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views, recomputed on read, under the given names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def period_outcome(fact: DataFrame) -> DataFrame:
    """Transactions and amount per period and outcome."""
    return (
        fact.groupBy("model_period", "outcome")
        .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("amount"))
        .orderBy("model_period", "outcome")
    )
