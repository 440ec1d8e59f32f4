"""Compact extract of the live period: coded columns, dictionaries, alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exact import cents
from riskloom.operators.dictionary import dictionary_encode
from riskloom.operators.ordering import dense_key
from riskloom.plans.tiles import LIVE
from riskloom.storage import BROADCAST_ROWS

DIMENSIONS = (
    "merchant_category", "channel", "state", "customer_segment", "fraud_type", "outcome", "risk_tier",
)
ALERT_FROM = 30


# What columns and alerts show of a transaction.
_SHOWN = (
    "transaction_id", "customer_id", "txn_timestamp", "txn_date", "txn_hour", "amount", "city", "anomaly_risk_score",
    "is_fraud", "is_flagged", *(d for d in DIMENSIONS if d != "customer_segment"), "txn_count_1h",
    "amount_to_avg_30d_ratio", "geo_velocity_kmh", "device_age_hours",
)


def live_rows(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Live transactions with segment and week, numbered from 0 by (time, id).
    The numbering stores its input, which columns, dictionaries and alerts then read."""
    rows = (
        fact.filter(F.col("model_period") == LIVE["model_period"])
        .select(*_SHOWN)
        .join(customers.select("customer_id", "customer_segment"), "customer_id")
        .join(dates.select("date", "week_start"), F.col("date") == F.col("txn_date"))
        .drop("date", "txn_date")
    )
    return dense_key(rows, ["txn_timestamp", "transaction_id"], "row", start=0)


def web_columns(live: DataFrame, short: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Coded columns, one row per live transaction, and the dictionaries; those
    above ``short`` values are numbered by a range exchange."""
    plain = live.select(
        "row",
        F.col("week_start").alias("week"),
        F.col("txn_hour").cast("int").alias("hour"),
        cents("amount").alias("cents"),
        F.col("anomaly_risk_score").cast("int").alias("score"),
        F.col("is_fraud").cast("int").alias("fraud"),
        F.col("is_flagged").cast("int").alias("flagged"),
        *DIMENSIONS,
    )
    return dictionary_encode(plain, ["week", *DIMENSIONS], short)


def web_alerts(live: DataFrame, at_least: int = ALERT_FROM) -> DataFrame:
    """Reviewable alerts with their drivers, rounded half to even, by score."""
    even = lambda c, digits, to: F.bround(F.col(c), digits).cast(to)
    return (
        live.filter(F.col("anomaly_risk_score") >= at_least)
        .orderBy(F.desc("anomaly_risk_score"), "transaction_id")
        .select(
            "transaction_id",
            "customer_id",
            F.date_format("txn_timestamp", "yyyy-MM-dd HH:mm").alias("timestamp"),
            "city",
            F.col("txn_count_1h").cast("int").alias("txn_count_1h"),
            even("amount_to_avg_30d_ratio", 1, "double").alias("spend_vs_30d_avg"),
            even("geo_velocity_kmh", 0, "bigint").alias("geo_speed_kmh"),
            even("device_age_hours", 1, "double").alias("device_age_hours"),
            "row",
        )
    )


MODEL_BLOCK = ("model_version", "split", "flag_threshold", "blend", "test_results")


def write_extract(live: DataFrame, document: DataFrame, base: str) -> None:
    """JSON lines per part of the extract, written by the executors; ``document``
    is the run's metrics document."""
    columns, dictionary = web_columns(live)
    header = live.agg(F.count(F.lit(1)).alias("rows"), F.lit("live period").alias("generated_from"))
    parts = {
        "columns": columns,
        "dictionaries": dictionary,
        "alerts": web_alerts(live),
        "model": document.select(*MODEL_BLOCK),
        "header": header,
    }
    for name, df in parts.items():
        df.write.mode("overwrite").json(f"{base}/{name}")
