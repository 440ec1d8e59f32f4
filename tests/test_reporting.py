from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from riskloom.functions.labels import LIVE_PERIOD
from riskloom.plans import tiles
from riskloom.plans.measures import Base, StarModel, between, measures, summarize

FACT = (
    "transaction_id string, customer_id string, state string, risk_tier string, is_flagged boolean, is_fraud boolean, "
    "outcome string, amount decimal(12,2), anomaly_risk_score int, model_period string, model_version string"
)


def row(i, state, tier, fraud, amount, customer="C1", period=LIVE_PERIOD):
    flagged = tier in ("High", "Critical")
    outcome = {(1, 1): "Fraud Prevented", (0, 1): "Fraud Missed", (1, 0): "False Alarm", (0, 0): "Cleared"}[flagged, fraud]
    score = {"Low": 5, "Medium": 40, "High": 65, "Critical": 90}[tier]
    return (f"T{i}", customer, state, tier, flagged, bool(fraud), outcome, Decimal(amount), score, period, "v1.0")


@pytest.fixture
def model(spark):
    fact = spark.createDataFrame(
        [
            row(1, "A", "Critical", 1, "100"),
            row(2, "A", "High", 0, "20"),
            row(3, "A", "Low", 1, "7", "C2"),
            row(4, "B", "Critical", 1, "50", "C9"),
            row(5, "B", "Low", 0, "3", "C2"),
            row(6, "C", "Medium", 0, "9", period="Training (Jan to Apr)"),
        ],
        FACT,
    )
    people = spark.createDataFrame([("C1", "Gold"), ("C2", "Basic")], "customer_id string, customer_segment string")
    return StarModel(fact, {"dim_customer": (people, "customer_id", "customer_id")})


def values(df, key=None):
    rows = df.collect()
    return [tuple(r) for r in rows] if key is None else {tuple(r[k] for k in key): r for r in rows}


def test_fixed_column_replaces_outer_filter(model):
    got = summarize(model, [], ["flagged_alerts", "critical_alerts"], {"risk_tier": "High"}).first()
    assert (got.flagged_alerts, got.critical_alerts) == (1, 2)


def test_fixed_column_on_an_axis_shows_its_total(model):
    got = values(summarize(model, ["risk_tier"], ["critical_alerts", "total_transactions"]), ["risk_tier"])
    assert {k[0]: (r.critical_alerts, r.total_transactions) for k, r in got.items()} == {
        "Critical": (2, 2), "High": (2, 1), "Medium": (2, 1), "Low": (2, 2)
    }
    by_state = values(summarize(model, ["state", "risk_tier"], ["critical_alerts"]), ["state", "risk_tier"])
    assert {k: r.critical_alerts for k, r in by_state.items()} == {
        ("A", "Critical"): 1, ("A", "High"): 1, ("A", "Low"): 1, ("B", "Critical"): 1, ("B", "Low"): 1,
    }  # state C has none, so its row is blank and drops out


def test_axis_under_a_filter_on_itself(model):
    got = summarize(model, ["risk_tier"], ["critical_alerts"], {"risk_tier": ["High"]})
    assert values(got) == [("High", 2)]


def test_blank_arithmetic(model):
    empty = {"state": "none"}
    names = ["total_transactions", "fraud_exposure", "fraud_rate", "net_savings", "avg_risk_score", "review_cost"]
    assert values(summarize(model, [], names, empty)) == [(None,) * 6]
    b = summarize(model, [], ["net_savings", "false_positive_rate"], {"state": "B"}).first()
    assert (float(b.net_savings), b.false_positive_rate) == (45.0, None)  # no false alarm is blank, not 0
    c = summarize(model, [], ["net_savings"], {"state": "C"}).first()
    assert c.net_savings is None
    none_caught = summarize(model, [], ["net_savings"], {"risk_tier": "High"}).first()
    assert float(none_caught.net_savings) == -5.0
    assert values(summarize(model, ["state"], ["fraud_exposure"], {"state": "C"})) == []


def test_dimension_axis_keeps_unmatched_rows(model):
    got = {r.customer_segment: r.total_volume for r in summarize(model, ["customer_segment"], ["total_volume"]).collect()}
    assert {k: float(v) for k, v in got.items()} == {"Gold": 129.0, "Basic": 10.0, None: 50.0}
    sliced = summarize(model, [], ["total_volume"], {"customer_segment": "Basic"}).first()
    assert float(sliced.total_volume) == 10.0


def test_range_filter_and_parameters(model):
    assert summarize(model, [], ["total_transactions"], {"anomaly_risk_score": between(40, 65)}).first()[0] == 2
    assert summarize(model, [], ["review_cost"], registry=measures(review_cost=8)).first()[0] == 24


def test_unknown_filter_is_an_error(model):
    with pytest.raises(ValueError, match="stat"):
        summarize(model, [], ["total_transactions"], {"stat": "A"})


def test_subtitle(model):
    assert summarize(model, [], ["report_subtitle"]).first()[0] == "Model v1.0  |  All periods  |  6 transactions scored"
    live = summarize(model, [], ["report_subtitle"], tiles.LIVE).first()[0]
    assert live == f"Model v1.0  |  {LIVE_PERIOD}  |  5 transactions scored"


def test_average_cannot_ignore_its_axis(model):
    with pytest.raises(ValueError):
        summarize(model, ["state"], ["x"], registry={"x": Base("avg", "amount", {"state": "A"})})


def test_page_and_slicer_filters_both_hold(model):
    got = tiles.tile("investigation_cards", model, {"risk_tier": ["High"]}).first()
    # the slicer narrows the page's tiers; critical alerts fix the tier and ignore both
    assert (got.flagged_alerts, got.critical_alerts) == (1, 2)
    got = tiles.tile("investigation_cards", model, {"risk_tier": ["Low"]}).first()
    assert (got.flagged_alerts, got.critical_alerts) == (None, 2)


def test_confusion_matrix(model):
    got = {r.is_fraud: (r.not_flagged, r.flagged) for r in tiles.confusion_matrix(model).collect()}
    assert got == {False: (1, 1), True: (1, 2)}


def test_live_filter_reaches_the_split(spark, make_fact):
    """The period label folds into a comparison of the stored split."""
    from riskloom.functions.labels import model_period

    df = spark.createDataFrame([("test",), ("train",)], "dataset_split string")
    plan = df.select("*", model_period(F.col("dataset_split")).alias("p")).filter(F.col("p") == LIVE_PERIOD)
    assert "CASE WHEN" not in plan._jdf.queryExecution().optimizedPlan().toString().split("Filter")[-1]
