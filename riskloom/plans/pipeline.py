"""The whole run: load, features, models, scores, evaluation, reporting, extract.

Every stage publishes a table under ``base`` and the next one reads it, so a lost
executor costs no more than its own tasks. Published tables are checked against
their declared rules before anything reads them; what was found is kept in
``validation_report``. A run starts from the load; intermediate tables go to a
scratch folder of the run and are deleted at its end.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.labels import FLAG_AT
from riskloom.models import boost, forest, matrix
from riskloom.models.trees import Ensemble, feature_importance
from riskloom.operators import integrity
from riskloom.plans import bi, evaluate, export, scoring, validation
from riskloom.plans.features import features
from riskloom.sources import star
from riskloom.sources.schemas import FEATURES, MODEL_PERFORMANCE, SCENARIO_RECALL, SCORES, STAR, TableSpec
from riskloom.storage import materialize, scratch_run

KEEP = ("transaction_id", "dataset_split", "is_fraud")


@dataclass(frozen=True)
class Settings:
    """Cutoffs and model sizes; the defaults of a half-year run."""

    valid_start: str = "2026-04-01"
    test_start: str = "2026-05-01"
    forest_trees: int = forest.TREES
    forest_sample: int = forest.SAMPLE
    boost_trees: int = boost.MAX_TREES
    boost_patience: int = boost.PATIENCE
    learning_rate: float = boost.LEARNING_RATE
    max_categories: int = matrix.MAX_CATEGORIES
    stop_on_violation: bool = True


def training_matrix(feats: DataFrame, settings: Settings, categories=None) -> tuple[DataFrame, list[str]]:
    """Model matrix of all rows, stored by split, and its column names. The
    category list is frozen from the rows given."""
    categories = matrix.frozen_categories(feats, most=settings.max_categories) if categories is None else categories
    rows = scoring.split(feats, settings.valid_start, settings.test_start)
    made = matrix.model_matrix(rows, KEEP, categories)
    return materialize(made, "matrix", ("dataset_split",)), matrix.matrix_columns(categories)


def fit(made: DataFrame, columns: list[str], settings: Settings) -> tuple[Ensemble, Ensemble]:
    """Isolation forest and boosted trees; neither sees the test part."""
    train = made.filter("dataset_split = 'train'")
    valid = made.filter("dataset_split = 'valid'")
    isolation = forest.fit_forest(
        train, columns, trees=settings.forest_trees, sample=settings.forest_sample
    )
    boosted = boost.fit_boost(
        train, valid, columns, max_trees=settings.boost_trees, patience=settings.boost_patience,
        learning_rate=settings.learning_rate,
    )
    return isolation, boosted


def score(made: DataFrame, isolation: Ensemble, boosted: Ensemble) -> DataFrame:
    """Published score columns of every row."""
    outputs = boost.score_boost(forest.score_forest(made, isolation), boosted)
    return scoring.blend(outputs.select(*KEEP, "isolation_anomaly_score", "xgb_fraud_probability"))


def test_rows(scores: DataFrame, fact: DataFrame, test_start: str) -> DataFrame:
    """Scores of the test part with labels and amounts. The split is by time, so
    the fact is cut at its source before it is joined."""
    labels = fact.filter(F.col("txn_timestamp") >= F.lit(test_start).cast("timestamp"))
    labels = labels.select("transaction_id", "amount", "is_fraud", "fraud_scenario")
    return scores.filter("dataset_split = 'test'").join(labels, "transaction_id")


def run(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, settings: Settings = Settings()) -> dict[str, int]:
    """Run all stages and return the row count of each published table. A table
    that breaks a declared rule stops the run, unless the settings say otherwise."""
    with scratch_run(spark):
        return _run(spark, tables, base, settings)


def _run(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, settings: Settings) -> dict[str, int]:
    table = lambda name: star.read_table(spark, base, name)
    report_path = f"{base}/validation_report/run={uuid.uuid4().hex}"

    def checked(specs: Mapping[str, TableSpec], parents: tuple[str, ...] = ()) -> None:
        integrity.enforce({n: table(n) for n in (*parents, *specs)}, specs, report_path, settings.stop_on_violation)

    counts = star.load_star(tables, base)
    checked(STAR)

    made = features(table("fact_transaction"), table("dim_customer"))
    counts["txn_features"] = star.publish(made.select(*FEATURES.schema.names), base, "txn_features")
    checked({"txn_features": FEATURES})
    feats = table("txn_features")
    report = validation.feature_validation(feats, table("fact_transaction"))
    counts["feature_validation"] = star.publish(report, base, "feature_validation")

    made, columns = training_matrix(feats, settings)
    isolation, boosted = fit(made, columns, settings)
    isolation.save(spark, f"{base}/models/isolation_forest")
    boosted.save(spark, f"{base}/models/boosted_trees")
    importance = materialize(feature_importance(boosted, spark), "importance")
    counts["feature_importance"] = star.publish(importance, base, "feature_importance")
    scored = score(made, isolation, boosted)
    counts["txn_risk_scores"] = star.publish(scored, base, "txn_risk_scores", ("dataset_split",))
    checked({"txn_risk_scores": SCORES}, ("fact_transaction",))
    scores = table("txn_risk_scores").select(*SCORES.schema.names)

    tested = materialize(test_rows(scores, table("fact_transaction"), settings.test_start), "scored_test")
    metrics = materialize(evaluate.evaluate(evaluate.policies(tested)), "metrics")
    document = evaluate.metrics_document(
        metrics,
        model_version=F.lit(scoring.MODEL_VERSION),
        split=F.create_map(
            F.lit("valid_start"), F.lit(settings.valid_start), F.lit("test_start"), F.lit(settings.test_start)
        ),
        flag_threshold=F.lit(FLAG_AT),
        blend=F.create_map(
            F.lit("xgboost"), F.lit(scoring.BLEND_WEIGHT),
            F.lit("isolation_forest"), F.lit(round(1 - scoring.BLEND_WEIGHT, 2)),
        ),
        xgboost_trees=F.lit(boosted.trees),
        feature_importance=importance.agg(
            F.map_from_entries(F.collect_list(F.struct("feature", "importance")))
        ).scalar(),
    )
    document.write.mode("overwrite").json(f"{base}/model_metrics")
    published = spark.read.schema(evaluate.METRICS_JSON).json(f"{base}/model_metrics")
    read_back = evaluate.flatten_metrics(published)

    bi_tables = {
        "bi_fact_transactions": (
            bi.bi_fact(table("fact_transaction"), scores, feats, table("dim_device")), ("model_period",)
        ),
        "bi_dim_customer": (bi.bi_customer(table("dim_customer")), ()),
        "bi_dim_date": (bi.bi_date(table("fact_transaction")), ()),
        "bi_model_performance": (evaluate.model_performance(read_back).select(*MODEL_PERFORMANCE.schema.names), ()),
        "bi_scenario_recall": (evaluate.scenario_table(read_back).select(*SCENARIO_RECALL.schema.names), ()),
    }
    for name, (df, partition_by) in bi_tables.items():
        counts[name] = star.publish(df, base, name, partition_by)
    checked({"bi_model_performance": MODEL_PERFORMANCE, "bi_scenario_recall": SCENARIO_RECALL})
    bi.register_views({name: table(name) for name in bi_tables})

    live = export.live_rows(table("bi_fact_transactions"), table("bi_dim_customer"), table("bi_dim_date"))
    export.write_extract(live, published, f"{base}/web")
    return counts
