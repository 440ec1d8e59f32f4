"""Out-of-time split and the blended risk score."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exact import micros, round_half_even
from riskloom.functions.labels import FLAG_AT, TIERS, risk_tier
from riskloom.plans.validation import share
from riskloom.sources.schemas import SCORES

MODEL_VERSION = "v1.0"
BLEND_WEIGHT = 0.8


def split(df: DataFrame, valid_start: str, test_start: str, ts: str = "txn_timestamp") -> DataFrame:
    """Adds ``dataset_split``: train before ``valid_start``, test from ``test_start`` on."""
    t = F.col(ts)
    at = lambda day: F.lit(day).cast("timestamp")
    part = F.when(t < at(valid_start), "train").when(t < at(test_start), "valid").otherwise("test")
    return df.withColumn("dataset_split", part)


def split_summary(df: DataFrame) -> DataFrame:
    """Rows, fraud share and time span per split."""
    rows = F.count(F.lit(1))
    return df.groupBy("dataset_split").agg(
        rows.alias("txns"),
        share(F.count_if("is_fraud"), rows, 4).cast("decimal(6,4)").alias("fraud_rate"),
        F.min("txn_timestamp").alias("first_txn"),
        F.max("txn_timestamp").alias("last_txn"),
    )


def positive_weight(train: DataFrame, label: str = "is_fraud") -> DataFrame:
    """One row: negatives / max(positives, 1)."""
    return train.agg(
        (F.count_if(~F.col(label)) / F.greatest(F.count_if(label), F.lit(1))).alias("pos_weight")
    )


def blend_score(probability: Column, isolation: Column, weight: float = BLEND_WEIGHT) -> Column:
    """0..100: weighted sum of a probability and a 0..100 anomaly score, ties to
    even. Decimal arithmetic keeps an exact .5 exact; the weights have the
    digits they were given, and sum to 1."""
    if not 0 <= weight <= 1:
        raise ValueError("the blend weight is between 0 and 1")
    share = Decimal(str(weight))
    exact = lambda x: F.lit(x).cast(f"decimal({max(0, -share.as_tuple().exponent) + 3},{max(0, -share.as_tuple().exponent)})")
    total = exact(share * 100) * probability.cast("decimal(6,5)") + exact(1 - share) * isolation.cast("decimal(5,2)")
    return round_half_even(total).cast("smallint")


def blend(
    df: DataFrame,
    weight: float = BLEND_WEIGHT,
    tiers=TIERS,
    flag_at: int = FLAG_AT,
    version: str = MODEL_VERSION,
) -> DataFrame:
    """Score rows from ``transaction_id``, ``dataset_split`` and the two model
    outputs; columns and types of the published score table."""
    scored = df.withColumns(
        {
            "xgb_fraud_probability": F.col("xgb_fraud_probability").cast("decimal(6,5)"),
            "isolation_anomaly_score": F.col("isolation_anomaly_score").cast("decimal(5,2)"),
        }
    ).withColumn(
        "anomaly_risk_score", blend_score(F.col("xgb_fraud_probability"), F.col("isolation_anomaly_score"), weight)
    )
    score = F.col("anomaly_risk_score")
    return scored.withColumns(
        {
            "risk_tier": risk_tier(score, tiers),
            "is_flagged": score >= flag_at,
            "model_version": F.lit(version),
            "scored_at": F.date_trunc("second", F.current_timestamp()),
        }
    ).select(*SCORES.schema.names)


def rule_outputs(features: DataFrame) -> DataFrame:
    """Two model-shaped outputs from fixed rules on the features: velocity,
    distance and new device for the probability, distance from home for the
    anomaly score. A stand-in for fitted models wherever results must be
    reproducible in plain SQL."""
    burst = (F.col("txn_count_1h") - 1) * 15000
    jump = F.when(F.col("km_from_prev_txn") > 500, 45000).otherwise(0)
    fresh = F.when(F.col("device_age_hours") == 0, 35000).otherwise(0)
    p5 = F.least(F.lit(100000), burst + jump + fresh)
    i2 = F.least(F.lit(10000), F.floor("km_from_home") * 20)
    return features.withColumns(
        {
            "xgb_fraud_probability": (p5.cast("decimal(10,0)") / 100000).cast("decimal(6,5)"),
            "isolation_anomaly_score": (i2.cast("decimal(10,0)") / 100).cast("decimal(5,2)"),
        }
    )


def tier_counts(scores: DataFrame, tiers=TIERS) -> DataFrame:
    """Test-period rows per tier, lowest tier first; absent tiers show NULL."""
    names = [name for _, name in reversed(tiers)]
    listed = F.array(*[F.struct(F.lit(i + 1).alias("o"), F.lit(n).alias("t")) for i, n in enumerate(names)])
    frame = scores.sparkSession.range(1).select(F.explode(listed).alias("x")).select(
        F.col("x.o").alias("tier_order"), F.col("x.t").alias("risk_tier")
    )
    seen = (
        scores.filter("dataset_split = 'test'").groupBy("risk_tier").agg(F.count(F.lit(1)).alias("txns"))
    )
    return frame.join(seen, "risk_tier", "left").select("risk_tier", "tier_order", "txns").orderBy("tier_order")
