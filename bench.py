"""Headline timings, one JSON line.

Stages run as a deployment runs them: the star schema is loaded once, each stage
publishes its table, report queries read the published tables. ``value`` is the
feature build over the loaded tables, written out.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from riskloom.models import boost, forest  # noqa: E402
from riskloom.operators.ordering import dense_key  # noqa: E402
from riskloom.plans import bi, evaluate, export, pipeline, scoring, tiles, validation  # noqa: E402
from riskloom.plans.features import features  # noqa: E402
from riskloom.session import local_session  # noqa: E402
from riskloom.sources import star, testdata  # noqa: E402
from riskloom.storage import materialize, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
SETTINGS = pipeline.Settings(valid_start=testdata.VALID_START, test_start=testdata.TEST_START)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def warm_up(spark: SparkSession) -> None:
    """Load and feature build on the smallest data, so that the timings are
    those of a running session; not timed."""
    base = scratch_path(spark, "warm_up")
    star.load_star(testdata.star(spark, os.path.join(os.path.dirname(SF_DIR), "sf0.001")), base)
    read = lambda name: star.read_table(spark, base, name)
    for _ in range(3):
        star.publish(features(read("fact_transaction"), read("dim_customer")), base, "txn_features")


def main() -> None:
    spark = local_session(CPUS, "bench")
    times: dict[str, float] = {}

    def timed(name, action):
        start = time.perf_counter()
        out = action()
        times[name] = round(time.perf_counter() - start, 3)
        return out

    warm_up(spark)
    base = scratch_path(spark, "bench")
    read = lambda name: star.read_table(spark, base, name)
    timed("star_load", lambda: star.load_star(testdata.star(spark, SF_DIR), base))
    fact, people = read("fact_transaction"), read("dim_customer")
    timed("feature_build", lambda: star.publish(features(fact, people), base, "txn_features"))
    feats = read("txn_features")
    timed("feature_validation", lambda: drain(validation.feature_validation(feats, fact)))

    made, columns = timed("training_matrix", lambda: pipeline.training_matrix(feats, SETTINGS))
    train, valid = (made.filter(f"dataset_split = '{part}'") for part in ("train", "valid"))
    isolation = timed("forest_fit_300x4096", lambda: forest.fit_forest(train, columns))
    timed("forest_score", lambda: drain(forest.score_forest(made, isolation)))
    boosted = timed(
        "boost_fit",
        lambda: boost.fit_boost(train, valid, columns),
    )
    timed("boost_score", lambda: drain(boost.score_boost(made, boosted)))

    outputs = scoring.rule_outputs(scoring.split(feats, SETTINGS.valid_start, SETTINGS.test_start))
    timed("score_publish", lambda: star.publish(scoring.blend(outputs), base, "txn_risk_scores", ("dataset_split",)))
    scores = read("txn_risk_scores")

    def metrics():
        tested = materialize(pipeline.test_rows(scores, fact, SETTINGS.test_start), "scored_test")
        drain(evaluate.evaluate(evaluate.policies(tested)))

    timed("policy_metrics", metrics)
    report = bi.bi_fact(fact, scores, feats, read("dim_device"))
    timed("bi_fact", lambda: star.publish(report, base, "bi_fact", ("model_period",)))
    model = tiles.star_model(read("bi_fact"), bi.bi_customer(people), bi.bi_date(fact))
    for name in tiles.TILES:
        timed(name, lambda n=name: drain(tiles.tile(n, model)))
    timed("alert_queue", lambda: drain(tiles.alert_queue(model)))
    timed("dense_key", lambda: drain(dense_key(fact, ["txn_timestamp", "customer_id", "transaction_id"], "n")))

    def extract():
        live = export.live_rows(model.fact, model.dimensions["dim_customer"][0], model.dimensions["dim_date"][0])
        drain(export.web_columns(live)[0])
        drain(export.web_alerts(live))

    timed("web_extract", extract)
    print(
        json.dumps(
            {
                "metric": "feature_build", "value": times["feature_build"], "unit": "sec", "queries": times,
                "total": round(sum(times.values()), 3), "sf": os.path.basename(SF_DIR), "cpus": int(CPUS),
                "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
