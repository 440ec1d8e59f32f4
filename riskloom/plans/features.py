"""Behavioural features: one row per transaction, from the customer's history
up to and including that transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exact import cents, elapsed_units, mean_cents, micros, ratio_milli, scaled, wall_micros
from riskloom.functions.geo import haversine_km
from riskloom.operators.history import HOT_ROWS, with_history

FRAMES = {"1h": 3_600, "24h": 86_400, "7d": 7 * 86_400, "30d": 30 * 86_400}
_TENTH_MINUTE = 6_000_000
_HUNDREDTH_HOUR = 36_000_000


def _clock(us: str) -> Column:
    """Zone-less timestamp from microseconds on its own clock."""
    seconds = (F.col(us).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def is_zoneless(fact: DataFrame) -> bool:
    return isinstance(fact.schema["txn_timestamp"].dataType, T.TimestampNTZType)


def history_rows(fact: DataFrame) -> DataFrame:
    """What features need of the transactions; time and amount travel through the shuffle once, as integers."""
    return fact.select(
        "transaction_id", "customer_id", "device_id", (wall_micros if is_zoneless(fact) else micros)("txn_timestamp").alias("ts_us"),
        cents("amount").alias("cents"), "merchant_category", "channel", "latitude", "longitude", "is_fraud",
    )


def behaviour(rows: DataFrame, customers: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Totals, sequence, previous row and first use of :func:`history_rows`."""
    return with_history(
        rows,
        key="customer_id",
        us="ts_us",
        row_id="transaction_id",
        value="cents",
        frames=FRAMES,
        previous=("ts_us", "latitude", "longitude"),
        first_use="device_id",
        attributes=customers.select("customer_id", "home_latitude", "home_longitude"),
        hot_rows=hot_rows,
    )


def features(fact: DataFrame, customers: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All feature columns; transactions of unknown customers drop out.

    Zone-less times are taken by their own clock, so neither the session's zone
    nor its changes to summer time matter; zoned times by the session's clock."""
    return feature_columns(behaviour(history_rows(fact), customers, hot_rows), is_zoneless(fact))


def feature_columns(history: DataFrame, zoneless: bool) -> DataFrame:
    """The published columns of :func:`behaviour`."""
    own, one = F.col("cents"), F.lit(1)
    point = (F.col("latitude"), F.col("longitude"))
    # Named once, since several features use each of these.
    prior = {f: (F.col(f"total_{f}"), F.col(f"count_{f}")) for f in ("7d", "30d")}
    history = history.withColumns(
        {
            **{f"total_{f}": F.col(f"sum_{f}") - own for f in prior},
            **{f"count_{f}": F.col(f"cnt_{f}") - one for f in prior},
            "gap_us": F.col("ts_us") - F.col("prev_ts_us"),
            "km_prev": haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), *point),
            "km_home": haversine_km(F.col("home_latitude"), F.col("home_longitude"), *point),
            "ts": _clock("ts_us") if zoneless else F.timestamp_micros("ts_us"),
        }
    ).withColumn("hour", F.hour("ts").cast("smallint"))
    gap_us, km_prev, ts, hour = (F.col(c) for c in ("gap_us", "km_prev", "ts", "hour"))
    # Elapsed time is held at one minute, so that simultaneous rows do not divide by zero.
    hours = F.greatest(gap_us / F.lit(3.6e9), F.lit(1.0 / 60))
    velocity = F.when(gap_us.isNotNull(), km_prev / hours)
    return history.select(
        "transaction_id",
        "customer_id",
        ts.alias("txn_timestamp"),
        scaled(own, 2).cast("decimal(12,2)").alias("amount"),
        "merchant_category",
        "channel",
        F.col("seq").alias("customer_txn_seq"),
        *[scaled(mean_cents(*prior[f]), 2).alias(f"avg_amount_{f}") for f in prior],
        *[scaled(ratio_milli(own, *prior[f]), 3).alias(f"amount_to_avg_{f}_ratio") for f in prior],
        F.col("cnt_1h").alias("txn_count_1h"),
        F.col("cnt_24h").alias("txn_count_24h"),
        scaled(F.col("sum_1h"), 2).alias("amount_sum_1h"),
        scaled(F.col("sum_24h"), 2).alias("amount_sum_24h"),
        scaled(elapsed_units(gap_us, _TENTH_MINUTE), 1).alias("minutes_since_prev_txn"),
        km_prev.cast("decimal(18,1)").alias("km_from_prev_txn"),
        velocity.cast("decimal(18,1)").alias("geo_velocity_kmh"),
        F.col("km_home").cast("decimal(18,1)").alias("km_from_home"),
        scaled(elapsed_units(F.col("ts_us") - F.col("first_use_us"), _HUNDREDTH_HOUR), 2).alias("device_age_hours"),
        hour.alias("hour_of_day"),
        (F.dayofweek(ts) - 1).cast("smallint").alias("day_of_week"),
        (hour < 5).alias("is_night"),
        (F.col("channel") == "online").alias("is_online"),
        "is_fraud",
    )
