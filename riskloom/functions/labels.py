"""Label expressions shared by scoring and the reporting tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier thresholds from the highest down, and the alert threshold.
TIERS = ((80, "Critical"), (60, "High"), (30, "Medium"), (0, "Low"))
FLAG_AT = 60

# Reporting labels.
LIVE_PERIOD = "Live (May to Jun)"
TRAINING_PERIOD = "Training (Jan to Apr)"
AGE_BANDS = ((25, "18-24"), (35, "25-34"), (50, "35-49"), (65, "50-64"))
OLDEST_BAND = "65+"


def first_match(value: Column, steps: Sequence[tuple[int, str]], default: str) -> Column:
    """First label whose threshold the value reaches."""
    out = None
    for threshold, label in steps:
        hit = value >= threshold
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def risk_tier(score: Column, tiers: Sequence[tuple[int, str]] = TIERS) -> Column:
    return first_match(score, tiers, tiers[-1][1])


def tier_order(tier: Column) -> Column:
    return F.when(tier == "Low", 1).when(tier == "Medium", 2).when(tier == "High", 3).otherwise(4)


def age_band(age: Column) -> Column:
    out = None
    for limit, label in AGE_BANDS:
        under = age < limit
        out = F.when(under, label) if out is None else out.when(under, label)
    return out.otherwise(OLDEST_BAND)


def title(text: Column) -> Column:
    """``gift_cards`` -> ``Gift Cards``."""
    return F.initcap(F.replace(text, F.lit("_"), F.lit(" ")))


def channel_label(channel: Column) -> Column:
    return F.when(channel == "online", "Online").otherwise("In-store")


def score_band(score: Column) -> Column:
    return (F.call_function("div", score, F.lit(10)) * 10).cast("int")


def outcome(flagged: Column, fraud: Column) -> Column:
    return (
        F.when(flagged & fraud, "Fraud Prevented")
        .when(~flagged & fraud, "Fraud Missed")
        .when(flagged & ~fraud, "False Alarm")
        .otherwise("Cleared")
    )


def model_period(split: Column) -> Column:
    return F.when(split == "test", LIVE_PERIOD).otherwise(TRAINING_PERIOD)


def padded_key(prefix: str, number: Column, width: int) -> Column:
    """``TXN`` + zero-padded number; wider numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))
