import itertools
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom.functions.labels import age_band, channel_label, outcome, padded_key, risk_tier, score_band, title
from riskloom.plans import evaluate, scoring
from riskloom.sources.schemas import SCORES


def test_blend_rounds_half_to_even(spark):
    rows = [("0.00625", "0.00"), ("0.01875", "0.00"), ("1.00000", "100.00"), ("0.00000", "2.50"), ("0.75000", "0.00")]
    df = spark.createDataFrame([(Decimal(a), Decimal(b)) for a, b in rows], "p decimal(6,5), i decimal(5,2)")
    got = [r[0] for r in df.select(scoring.blend_score(F.col("p"), F.col("i"))).collect()]
    assert got == [0, 2, 100, 0, 60]  # 0.5, 1.5, 100, 0.5, 60


def test_tiers_and_flags_at_their_thresholds(spark):
    rows = [(f"T{s}", "test", Decimal(s) / 80, Decimal(0)) for s in (0, 29, 30, 59, 60, 79, 80)]
    df = spark.createDataFrame(
        rows, "transaction_id string, dataset_split string, xgb_fraud_probability decimal(20,10), "
        "isolation_anomaly_score decimal(5,2)"
    )
    out = scoring.blend(df)
    assert [f.dataType for f in out.schema] == [f.dataType for f in SCORES.schema]
    got = {r.anomaly_risk_score: (r.risk_tier, r.is_flagged) for r in out.collect()}
    assert got == {
        0: ("Low", False), 29: ("Low", False), 30: ("Medium", False), 59: ("Medium", False),
        60: ("High", True), 79: ("High", True), 80: ("Critical", True),
    }


def test_absent_tiers_show(spark):
    df = spark.createDataFrame([("High", "test"), ("Low", "train")], "risk_tier string, dataset_split string")
    assert [(r.risk_tier, r.txns) for r in scoring.tier_counts(df).collect()] == [
        ("Low", None), ("Medium", None), ("High", 1), ("Critical", None)
    ]


def test_labels(spark):
    row = spark.range(1).select(
        title(F.lit("gift_cards")), channel_label(F.lit("in_store")), score_band(F.lit(100)), score_band(F.lit(59)),
        age_band(F.lit(24)), age_band(F.lit(65)), risk_tier(F.lit(100)), outcome(F.lit(False), F.lit(True)),
        padded_key("C", F.lit(7), 6), padded_key("C", F.lit(12345678), 6),
    ).first()
    assert tuple(row) == (
        "Gift Cards", "In-store", 100, 50, "18-24", "65+", "Critical", "Fraud Missed", "C000007", "C12345678"
    )


def brute_ranking(rows):
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(p >= cut for p in pos)
        ap += sum(p == cut for p in pos) / len(pos) * tp / (tp + sum(n >= cut for n in neg))
    return round(auc, 4), round(ap, 4)


def test_ranking_quality(spark):
    import random

    rng = random.Random(8)
    data = {m: [(round(rng.random() * size, 2), rng.random() < 0.2) for _ in range(400)] for m, size in (("a", 1), ("b", 900))}
    df = spark.createDataFrame([(m, s, y) for m, rows in data.items() for s, y in rows], "m string, s double, y boolean")
    for r in evaluate.ranking_quality(df, "y", "s", "m").collect():
        assert (r.roc_auc, r.pr_auc) == brute_ranking(data[r.m])


def test_single_class_and_no_alerts(spark):
    df = spark.createDataFrame(
        [("m", 0.1, False, Decimal("5.00"), False, None), ("m", 0.2, False, Decimal("6.00"), False, None)],
        "model string, score double, flagged boolean, amount decimal(12,2), is_fraud boolean, fraud_scenario string",
    )
    r = evaluate.evaluate(df).first()
    assert r.roc_auc is None and r.pr_auc is None and r.recall_by_scenario is None
    assert (r.flagged_txns, r.precision, r.recall, r.dollar_recall) == (0, 0, 0, 0)


def test_alert_quality(spark):
    combos = list(itertools.product([True, False], [True, False]))
    rows = [("m", f, y, Decimal(i + 1), "s" if y else None) for i, (f, y) in enumerate(combos * 2)]
    df = spark.createDataFrame(rows, "model string, flagged boolean, is_fraud boolean, amount decimal(12,2), sc string")
    r = evaluate.alert_quality(df, "is_fraud", "flagged", "amount", "model").first()
    assert (r.flagged_txns, float(r.precision), float(r.recall), float(r.false_positive_rate)) == (4, 0.5, 0.5, 0.5)
    assert (float(r.fraud_dollars), float(r.fraud_dollars_caught), float(r.dollar_recall)) == (16, 6, 0.375)
    got = evaluate.scenario_recall(df, "is_fraud", "flagged", "sc", "model").first()
    assert (got.scenario, float(got.recall)) == ("s", 0.5)


def test_split_cutoffs(spark):
    df = spark.sql(
        "SELECT explode(array(timestamp '2026-03-31 23:59:59.999999', timestamp '2026-04-01', "
        "timestamp '2026-04-30 23:59:59', timestamp '2026-05-01')) AS txn_timestamp"
    )
    got = [r.dataset_split for r in scoring.split(df, "2026-04-01", "2026-05-01").collect()]
    assert got == ["train", "valid", "valid", "test"]
    none = spark.createDataFrame([(False,), (False,)], "is_fraud boolean")
    assert scoring.positive_weight(none).first()[0] == 2.0


@pytest.mark.parametrize("cut", [None])
def test_policies_have_four_rows_per_transaction(spark, cut):
    df = spark.createDataFrame(
        [(Decimal("600"), Decimal("50.0"), Decimal("0.5"), 60, True, True, "x"),
         (Decimal("10"), Decimal("1.0"), Decimal("0.1"), 5, False, False, None)],
        "amount decimal(12,2), isolation_anomaly_score decimal(5,2), xgb_fraud_probability decimal(6,5), "
        "anomaly_risk_score short, is_flagged boolean, is_fraud boolean, fraud_scenario string",
    )
    got = evaluate.policies(df, cut).collect()
    assert len(got) == 8 and sum(r.flagged for r in got) == 4


@pytest.mark.parametrize(("weight", "want"), [(0.995, 0), (0.815, 18), (0.8, 20), (1.0, 0), (0.0, 100)])
def test_blend_weights_keep_their_digits(spark, weight, want):
    row = spark.sql("SELECT cast(0 AS decimal(6,5)) p, cast(100 AS decimal(5,2)) i")
    assert row.select(scoring.blend_score(F.col("p"), F.col("i"), weight)).first()[0] == want


def test_unknown_model_is_an_error(spark):
    from riskloom.plans import evaluate

    metrics = spark.sql("SELECT 'mystery' AS model, map('a', cast(1 AS decimal(6,4))) AS recall_by_scenario")
    with pytest.raises(Exception, match="mystery"):
        evaluate.scenario_table(metrics).collect()


@pytest.mark.parametrize("hits, total", [(1, 16), (5, 16), (1, 80), (1, 32), (3, 32), (7, 16), (0, 9), (9, 9), (2, 3)])
def test_rates_round_ties_to_even(spark, hits, total):
    from decimal import ROUND_HALF_EVEN, Decimal

    rows = [("m", k < hits, True, "10.00", "s") for k in range(total)]
    df = spark.createDataFrame(rows, "model string, is_fraud boolean, flagged boolean, amount string, fraud_scenario string")
    df = df.withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    exact = lambda a, b, digits: (Decimal(a) / Decimal(b)).quantize(Decimal(10) ** -digits, ROUND_HALF_EVEN)
    got = evaluate.alert_quality(df, "is_fraud", "flagged", "amount", "model").first()
    assert got["precision"] == exact(hits, total, 3)
    assert got.false_positive_rate == (1 if hits < total else 0)
    caught = df.withColumns({"flagged": F.col("is_fraud"), "is_fraud": F.lit(True)})
    found = evaluate.alert_quality(caught, "is_fraud", "flagged", "amount", "model").first()
    assert found.recall == found.dollar_recall == exact(hits, total, 3)
    wrong = df.withColumns({"flagged": F.col("is_fraud"), "is_fraud": F.lit(False)})
    assert evaluate.alert_quality(wrong, "is_fraud", "flagged", "amount", "model").first().false_positive_rate == exact(hits, total, 4)
    recall = evaluate.scenario_recall(caught, "is_fraud", "flagged", "fraud_scenario", "model").first()
    assert recall.recall == exact(hits, total, 3)
