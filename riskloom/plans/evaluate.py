"""Evaluation of alert policies: ranking quality, alert quality, dollars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.exact import rate_half_even
from riskloom.functions.labels import title
from riskloom.operators.ordering import exact_quantiles, running_totals
from riskloom.sources.schemas import MODEL_PERFORMANCE, SCENARIO_RECALL
from riskloom.storage import materialize

# Published model names, labels and order; pass other labels to the tables below.
MODEL_LABELS = {
    "rule: amount >= $500": ("Rule: amount >= $500", 1),
    "isolation_forest": ("Isolation Forest", 2),
    "xgboost": ("XGBoost", 3),
    "risk_blend": ("Risk score (blend)", 4),
}
RULE_AMOUNT = 500


def equal_volume_cut(test: DataFrame, score: str = "isolation_anomaly_score") -> DataFrame:
    """One row: the score at which an alert policy raises as many alerts as the
    flags do, the exact quantile at 1 - flag share."""
    flagged = test.agg((F.lit(1.0) - F.count_if("is_flagged") / F.nullif(F.count(F.lit(1)), F.lit(0))).alias("q")).scalar()
    return exact_quantiles(test, [], [score], flagged).withColumnRenamed(score, "cut")


def policies(test: DataFrame, cut: Column | None = None) -> DataFrame:
    """Long format, one row per (transaction, policy): model, score, flagged."""
    cut = equal_volume_cut(test).scalar() if cut is None else cut
    amount, iso, prob = F.col("amount"), F.col("isolation_anomaly_score"), F.col("xgb_fraud_probability")
    chosen = {
        "rule: amount >= $500": (amount, amount >= RULE_AMOUNT),
        "isolation_forest": (iso, iso.cast("double") >= cut),
        "xgboost": (prob, prob >= F.lit("0.5").cast("decimal(2,1)")),
        "risk_blend": (F.col("anomaly_risk_score"), F.col("is_flagged")),
    }
    entries = F.array(
        *[
            F.struct(F.lit(m).alias("model"), s.cast("double").alias("score"), f.alias("flagged"))
            for m, (s, f) in chosen.items()
        ]
    )
    return test.select("is_fraud", "amount", "fraud_scenario", F.explode(entries).alias("p")).select(
        "p.model", "p.score", "p.flagged", "is_fraud", "amount", "fraud_scenario"
    )


def _ones(rows: str | None) -> Column:
    """How many rows a row stands for."""
    return F.lit(1).cast("bigint") if rows is None else F.col(rows)


def _rows_where(condition: Column, rows: str | None) -> Column:
    return F.coalesce(F.sum(F.when(condition, _ones(rows))), F.lit(0))


def ranking_quality(df: DataFrame, label: str, score: str, by: str, rows: str | None = None) -> DataFrame:
    """(by, roc_auc, pr_auc). Rows shrink to counts per distinct score; ROC-AUC
    counts tied pairs half, PR-AUC is the average precision over thresholds.
    A single class gives NULL. ``rows`` names a count of equal rows."""
    hist = df.groupBy(by, F.col(score).alias("score")).agg(
        _rows_where(F.col(label), rows).alias("pos"), _rows_where(~F.col(label), rows).alias("neg")
    )
    runs = running_totals(hist, [by], "score", ["pos", "neg"], descending=True)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    # Twice the number of (positive, negative) pairs ranked the right way, ties half.
    won = F.sum(wide("pos") * (2 * (F.col("neg_all") - F.col("neg_upto")) + F.col("neg")).cast("decimal(19,0)"))
    pairs = F.max(wide("pos_all") * wide("neg_all")).cast("double")
    precision = F.col("pos_upto") / (F.col("pos_upto") + F.col("neg_upto"))
    return runs.groupBy(by).agg(
        F.round(won.cast("double") / 2 / F.nullif(pairs, F.lit(0.0)), 4).alias("roc_auc"),
        F.round(F.sum(F.col("pos") * precision) / F.nullif(F.max("pos_all"), F.lit(0)), 4).alias("pr_auc"),
    )


def alert_quality(df: DataFrame, label: str, flag: str, amount: str, by: str, rows: str | None = None) -> DataFrame:
    """Confusion counts, rates and dollars per policy, in one aggregate. ``rows``
    names a count of equal rows, ``amount`` is then their sum."""
    y, f = F.col(label), F.col(flag)
    money = lambda cond: F.coalesce(F.sum(F.when(cond, F.col(amount))), F.lit(0)).cast("decimal(22,2)")
    counts = df.groupBy(by).agg(
        _rows_where(f & y, rows).alias("tp"),
        _rows_where(f & ~y, rows).alias("fp"),
        _rows_where(y, rows).alias("frauds"),
        _rows_where(~y, rows).alias("legit"),
        money(y).alias("fraud_dollars"),
        money(f & y).alias("fraud_dollars_caught"),
    )
    at_least_one = lambda c: F.greatest(c, F.lit(1))
    tp, fp = F.col("tp"), F.col("fp")
    rate = lambda hits, base, digits: rate_half_even(hits, at_least_one(base), digits).cast("decimal(6,4)")
    whole_cents = lambda c: (F.col(c) * 100).cast("decimal(24,0)")
    return counts.select(
        by,
        (tp + fp).alias("flagged_txns"),
        rate(tp, tp + fp, 3).alias("precision"),
        rate(tp, F.col("frauds"), 3).alias("recall"),
        rate(fp, F.col("legit"), 4).alias("false_positive_rate"),
        "fraud_dollars",
        "fraud_dollars_caught",
        rate(whole_cents("fraud_dollars_caught"), whole_cents("fraud_dollars"), 3).alias("dollar_recall"),
    )


def scenario_recall(
    df: DataFrame, label: str, flag: str, scenario: str, by: str, rows: str | None = None
) -> DataFrame:
    """(by, scenario, recall) over the positive rows."""
    return (
        df.filter(F.col(label) & F.col(scenario).isNotNull())
        .groupBy(by, F.col(scenario).alias("scenario"))
        .agg(rate_half_even(_rows_where(F.col(flag), rows), F.sum(_ones(rows)), 3).cast("decimal(6,4)").alias("recall"))
    )


def evaluate(
    df: DataFrame,
    label: str = "is_fraud",
    score: str = "score",
    flag: str = "flagged",
    amount: str = "amount",
    scenario: str = "fraud_scenario",
    by: str = "model",
) -> DataFrame:
    """All metrics per policy, with a map of recall by scenario. The rows are read
    once, into counts and amounts of equal outcomes, which carry every metric."""
    counted = df.groupBy(by, score, flag, label, scenario).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(amount).alias("_amount")
    )
    df = materialize(counted, "outcomes")
    recalls = (
        scenario_recall(df, label, flag, scenario, by, "_rows")
        .groupBy(by)
        .agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("scenario", "recall")))).alias(
                "recall_by_scenario"
            )
        )
    )
    return (
        ranking_quality(df, label, score, by, "_rows")
        .join(alert_quality(df, label, flag, "_amount", by, "_rows"), by)
        .join(recalls, by, "left")
    )


def _labelled(df: DataFrame, labels: Mapping[str, tuple[str, int]]) -> DataFrame:
    entries = [x for name, (label, order) in labels.items() for x in (
        F.lit(name), F.struct(F.lit(label).alias("label"), F.lit(order).cast("smallint").alias("sort_order")))]
    unknown = F.raise_error(F.concat(F.lit("no published label for model "), F.coalesce("model", F.lit("NULL"))))
    return df.withColumn("_known", F.coalesce(F.create_map(*entries)[F.col("model")], unknown))


def model_performance(metrics: DataFrame, labels=MODEL_LABELS) -> DataFrame:
    """Published metric table: labelled, ordered, fixed types."""
    named = _labelled(metrics, labels).select(
        F.col("_known.label").alias("model"),
        F.col("_known.sort_order").alias("sort_order"),
        "roc_auc", "pr_auc", "flagged_txns",
        F.col("precision").alias("precision_rate"),
        F.col("recall").alias("recall_rate"),
        "false_positive_rate", "fraud_dollars", "fraud_dollars_caught", "dollar_recall",
    )
    return named.select(*[F.col(f.name).cast(f.dataType) for f in MODEL_PERFORMANCE.schema])


def scenario_table(metrics: DataFrame, labels=MODEL_LABELS) -> DataFrame:
    """Published recall table, one row per model and fraud type."""
    named = (
        _labelled(metrics, labels)
        .select("_known", F.explode("recall_by_scenario").alias("scenario", "recall"))
        .select(
            F.col("_known.label").alias("model"),
            F.col("_known.sort_order").alias("sort_order"),
            title(F.col("scenario")).alias("fraud_type"),
            F.col("recall").alias("recall_rate"),
        )
    )
    return named.select(*[F.col(f.name).cast(f.dataType) for f in SCENARIO_RECALL.schema])


METRICS_JSON = (
    "model_version string, split map<string,string>, flag_threshold int, blend map<string,double>, "
    "xgboost_trees int, test_results array<struct<model string, roc_auc double, pr_auc double, "
    "flagged_txns bigint, precision decimal(6,4), recall decimal(6,4), false_positive_rate decimal(6,4), "
    "fraud_dollars decimal(22,2), fraud_dollars_caught decimal(22,2), dollar_recall decimal(6,4), "
    "recall_by_scenario map<string,decimal(6,4)>>>, feature_importance map<string,double>"
)


def metrics_document(metrics: DataFrame, **header: Column) -> DataFrame:
    """One row per run: header fields and the per-model metrics as a nested
    array (a handful of models). ``header`` adds further top-level fields."""
    order = F.create_map(*[x for n, (_, o) in MODEL_LABELS.items() for x in (F.lit(n), F.lit(o))])
    place = F.coalesce(order[F.col("model")], F.lit(len(MODEL_LABELS) + 1))
    # Maps do not sort, so the rows go through a map keyed by their place.
    packed = metrics.select(F.struct(place, "model").alias("place"), F.struct(*metrics.columns).alias("row"))
    listed = packed.agg(F.map_from_entries(F.collect_list(F.struct("place", "row"))).alias("by_place"))
    rows = F.transform(F.array_sort(F.map_keys("by_place")), lambda k: F.element_at("by_place", k))
    return listed.select(*[v.alias(k) for k, v in header.items()], rows.alias("test_results"))


def flatten_metrics(documents: DataFrame) -> DataFrame:
    """Metrics rows back from documents read with :data:`METRICS_JSON`."""
    return documents.select(F.explode("test_results").alias("r")).select("r.*")
