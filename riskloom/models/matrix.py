"""Feature matrix: numeric columns, history indicator, one-hot categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.sources.schemas import MERCHANT_CATEGORIES

# Model inputs in order. Scenario and trust labels are never inputs.
NUMERIC = (
    "amount", "customer_txn_seq",
    "avg_amount_7d", "avg_amount_30d", "amount_to_avg_7d_ratio", "amount_to_avg_30d_ratio",
    "txn_count_1h", "txn_count_24h", "amount_sum_1h", "amount_sum_24h",
    "minutes_since_prev_txn", "km_from_prev_txn", "geo_velocity_kmh", "km_from_home",
    "device_age_hours", "hour_of_day", "day_of_week", "is_night", "is_online",
)
# What a missing value means for a customer without history.
FILL = {
    "amount_to_avg_7d_ratio": 1.0,
    "amount_to_avg_30d_ratio": 1.0,
    "minutes_since_prev_txn": 43_200.0,
    "km_from_prev_txn": 0.0,
    "geo_velocity_kmh": 0.0,
}
CATEGORIES = tuple(sorted(MERCHANT_CATEGORIES))
MAX_CATEGORIES = 500
# The category that stands for all values a model has no column for.
RARE = "__rare__"


def frozen_categories(train: DataFrame, column: str = "merchant_category", most: int = MAX_CATEGORIES) -> tuple[str, ...]:
    """The category list to keep with a model, sorted: a column of the matrix
    each, ``most`` at the most. If there are more values, the ``most - 1`` with
    the most rows (ties: the smaller name) keep columns of their own and all
    others, those first seen later included, share the column of ``RARE``, which
    ends the list. NULL is no category. The driver gets ``most + 1`` names."""
    if most < 1:
        raise ValueError("a matrix needs room for one category at least")
    counts = train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    names = [r[0] for r in counts.orderBy(F.desc("_rows"), column).limit(most + 1).collect()]
    if len(names) <= most:
        return tuple(sorted(names))
    return (*sorted(n for n in names[: most - 1] if n != RARE), RARE)


def matrix_columns(categories: Sequence[str] = CATEGORIES) -> list[str]:
    """Names of the matrix in order; the column of ``RARE`` is the last."""
    return [*NUMERIC, "has_history", *[f"cat_{c}" for c in sorted(categories, key=lambda c: c == RARE)]]


def model_matrix(
    features: DataFrame, keep: Sequence[str] = ("transaction_id",), categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """``keep`` columns and the matrix, all doubles and without NULLs."""
    number = {c: F.col(c).cast("int" if c.startswith("is_") else "double").cast("double") for c in NUMERIC}
    has_history = F.col("avg_amount_30d").isNotNull().cast("int").cast("double")
    for c in ("avg_amount_7d", "avg_amount_30d"):
        number[c] = F.coalesce(number[c], number["amount"])
    for c, value in FILL.items():
        number[c] = F.coalesce(number[c], F.lit(value))
    category = F.col("merchant_category")
    listed = [c for c in categories if c != RARE]
    one_hot = [F.when(category == c, 1.0).otherwise(0.0).alias(f"cat_{c}") for c in listed]
    if RARE in categories:
        other = category.isNotNull() & ~category.isin(listed) if listed else category.isNotNull()
        one_hot.append(F.when(other, 1.0).otherwise(0.0).alias(f"cat_{RARE}"))
    return features.select(
        *[F.col(c).alias(f"_k_{c}") for c in keep],
        *[n.alias(c) for c, n in number.items()],
        has_history.alias("has_history"),
        *one_hot,
    ).withColumnsRenamed({f"_k_{c}": c for c in keep if c not in number})
