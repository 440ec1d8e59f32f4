"""Every report query as a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.labels import LIVE_PERIOD
from riskloom.plans.measures import MEASURES, Base, StarModel, matches, summarize

LIVE = {"model_period": LIVE_PERIOD}
REVIEW = {**LIVE, "risk_tier": ("Medium", "High", "Critical")}


@dataclass(frozen=True)
class Tile:
    axes: tuple[str, ...]
    measures: tuple[str, ...]
    page: Mapping[str, object] = field(default_factory=dict)
    # (column, descending)
    order: tuple[tuple[str, bool], ...] = ()


TILES = {
    "kpi_cards": Tile(
        (),
        ("fraud_exposure", "fraud_prevented", "prevention_rate", "flagged_alerts", "alert_precision",
         "false_positive_rate"),
        LIVE,
    ),
    "weekly_trend": Tile(("week_start",), ("fraud_prevented", "fraud_missed"), LIVE, (("week_start", False),)),
    "exposure_by_attack": Tile(
        ("fraud_type", "outcome"), ("fraud_exposure",), LIVE,
        (("fraud_exposure", True), ("fraud_type", False), ("outcome", False)),
    ),
    "exposure_by_state": Tile(("state",), ("fraud_exposure",), LIVE, (("fraud_exposure", True), ("state", False))),
    "alerts_by_tier": Tile(("risk_tier", "risk_tier_order"), ("flagged_alerts",), LIVE, (("risk_tier_order", False),)),
    "investigation_cards": Tile(
        (),
        ("flagged_alerts", "critical_alerts", "alert_precision", "fraud_prevented", "fraud_prevented_per_alert"),
        REVIEW,
    ),
    "risk_scatter": Tile(("transaction_id", "outcome"), ("sum_amount", "sum_risk_score"), REVIEW),
    "alerts_by_hour": Tile(("txn_hour",), ("flagged_alerts",), REVIEW, (("txn_hour", False),)),
    "fraud_rate_by_band": Tile(("score_band",), ("fraud_rate",), LIVE, (("score_band", False),)),
    "band_counts": Tile(
        ("score_band", "is_fraud"), ("total_transactions",), LIVE, (("score_band", False), ("is_fraud", False))
    ),
}

QUEUE_COLUMNS = (
    "transaction_id", "txn_timestamp", "customer_id", "amount", "merchant_category", "city",
    "anomaly_risk_score", "risk_tier", "txn_count_1h", "amount_to_avg_30d_ratio", "geo_velocity_kmh",
    "device_age_hours", "outcome",
)
SLICERS = {
    "overview": ("month_short", "channel", "customer_segment", "merchant_category"),
    "investigation": ("risk_tier", "state", "merchant_category", "model_period"),
}
SCORECARD = (
    "roc_auc", "pr_auc", "precision_rate", "recall_rate", "false_positive_rate", "flagged_txns",
    "fraud_dollars_caught", "dollar_recall",
)


def star_model(fact: DataFrame, customers: DataFrame, dates: DataFrame) -> StarModel:
    return StarModel(
        fact,
        {"dim_customer": (customers, "customer_id", "customer_id"), "dim_date": (dates, "txn_date", "date")},
    )


def both(page: Mapping[str, object], slicer: Mapping[str, object]) -> dict[str, object]:
    """Page and slicer filters on one column must both hold."""
    out = dict(page)
    for column, wanted in slicer.items():
        if column in out:
            first, second = out[column], wanted
            out[column] = lambda c, a=first, b=second: matches(c, a) & matches(c, b)
        else:
            out[column] = wanted
    return out


def tile(
    name: str,
    model: StarModel,
    filters: Mapping[str, object] | None = None,
    page: Mapping[str, object] | None = None,
    registry=MEASURES,
) -> DataFrame:
    """A report query under extra slicer filters; ``page`` replaces the page's own filter."""
    t = TILES[name]
    kept = both(t.page if page is None else page, filters or {})
    out = summarize(model, t.axes, t.measures, kept, registry)
    return out.orderBy(*[F.col(c).desc() if down else F.col(c).asc() for c, down in t.order]) if t.order else out


def alert_queue(model: StarModel, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Reviewable transactions, highest score first, ties by transaction."""
    rows = model.rows((), both(REVIEW, filters or {}))
    return rows.select(*QUEUE_COLUMNS).orderBy(F.desc("anomaly_risk_score"), "transaction_id")


def slicer_options(model: StarModel, columns: Sequence[str], filters: Mapping[str, object] | None = None) -> DataFrame:
    """(slicer, option): the distinct values of each slicer column that occur."""
    rows, _ = model.source(columns, filters or {})
    pairs = F.array(*[F.struct(F.lit(c).alias("slicer"), F.col(c).cast("string").alias("option")) for c in columns])
    return rows.select(F.explode(pairs).alias("p")).select("p.*").distinct()


def scorecard(performance: DataFrame, metrics: Sequence[str] = SCORECARD) -> DataFrame:
    """Stored metrics per model, in published order."""
    return (
        performance.groupBy("model", "sort_order").agg(*[F.sum(m).alias(m) for m in metrics]).orderBy("sort_order")
    )


def model_vs_rule(performance: DataFrame) -> DataFrame:
    return scorecard(performance, ("dollar_recall", "precision_rate"))


def scenario_matrix(recall: DataFrame, models: Sequence[str]) -> DataFrame:
    """Fraud types by models, recall in the cells."""
    return recall.groupBy("fraud_type").pivot("model", list(models)).agg(F.sum("recall_rate")).orderBy("fraud_type")


def confusion_matrix(model: StarModel, filters: Mapping[str, object] | None = None) -> DataFrame:
    """Actual fraud by alert, transaction counts in the cells."""
    rows, over = model.source(("is_fraud", "is_flagged"), both(LIVE, filters or {}))
    return (
        rows.groupBy("is_fraud")
        .pivot("is_flagged", [False, True])
        .agg(over(Base("count"), F.lit(True)))
        .withColumnsRenamed({"false": "not_flagged", "true": "flagged"})
        .orderBy("is_fraud")
    )
