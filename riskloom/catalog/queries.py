"""Registered queries: (spark, sf_dir) -> DataFrame.

Every query reads the provided tables as the star schema of
:mod:`riskloom.sources.testdata`. Results leave through :func:`portable`, which
turns decimals into doubles and dates into ISO text, so that any engine's client
shows the same values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.exact import round_half_even
from riskloom.functions.geo import haversine_km
from riskloom.models import boost, forest, matrix
from riskloom.models.trees import Ensemble
from riskloom.models.trees import feature_importance as gain_share
from riskloom.operators import calendar as cal
from riskloom.operators import distance, integrity, repeats
from riskloom.operators.history import rolling
from riskloom.operators.ordering import dense_key, exact_quantiles
from riskloom.plans import bi, cubes, daily, evaluate, export, pipeline, scoring, tiles, validation
from riskloom.plans.features import features
from riskloom.plans.measures import MEASURES, between, summarize
from riskloom.sources import star, testdata
from riskloom.sources.schemas import FEATURES, MODEL_PERFORMANCE, SCENARIO_RECALL, SCORES, STAR
from riskloom.storage import exists, materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    def convert(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        return c

    return df.select(*[convert(f) for f in df.schema])


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
    return fn


# ---------------------------------------------------------------- shared inputs


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(testdata.transactions(spark, sf_dir), testdata.customers(spark, sf_dir))


def _split(df: DataFrame) -> DataFrame:
    return scoring.split(df, testdata.VALID_START, testdata.TEST_START)


def _outputs(feats: DataFrame) -> DataFrame:
    return scoring.rule_outputs(_split(feats))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.blend(_outputs(_features(spark, sf_dir)))


def _scored_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test-period rows with labels and scores, written once."""
    rows = pipeline.test_rows(_scores(spark, sf_dir), testdata.transactions(spark, sf_dir), testdata.TEST_START)
    return materialize(rows, "scored_test")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.evaluate(evaluate.policies(_scored_test(spark, sf_dir)))


_REPORTS: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple:
    """Session, folder and state of its files: what was made from them is kept under it."""
    return spark.sparkContext.applicationId, sf_dir, *testdata.version(spark, sf_dir)


def _bi_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reporting fact of a data folder, by period. It is published again if
    the folder's files have changed or the published tables are gone."""
    key = _key(spark, sf_dir)
    if key not in _REPORTS or not exists(spark, _REPORTS[key]):
        tables = testdata.star(spark, sf_dir)
        base = scratch_path(spark, "reports")
        star.publish(features(tables["fact_transaction"], tables["dim_customer"]), base, "txn_features")
        feats = star.read_table(spark, base, "txn_features")
        fact = bi.bi_fact(tables["fact_transaction"], scoring.blend(_outputs(feats)), feats, tables["dim_device"])
        star.publish(fact, base, "bi_fact_transactions", ("model_period",))
        _REPORTS[key] = base
    fact = star.read_table(spark, _REPORTS[key], "bi_fact_transactions")
    return fact.select(*[c for c in fact.columns if c != "model_period"], "model_period")


def _model(spark: SparkSession, sf_dir: str) -> tiles.StarModel:
    tables = testdata.star(spark, sf_dir)
    return tiles.star_model(
        _bi_fact(spark, sf_dir), bi.bi_customer(tables["dim_customer"]), bi.bi_date(tables["fact_transaction"])
    )


# ------------------------------------------------------------- load and checks


@query
def load_counts(spark, sf_dir):
    return star.table_counts(testdata.star(spark, sf_dir))


@query
def star_reload(spark, sf_dir):
    """Load twice into the same place; the second load replaces the first."""
    base = scratch_path(spark, "star")
    tables = testdata.star(spark, sf_dir)
    star.load_star(tables, base)
    star.load_star(tables, base)
    return star.table_counts(star.read_star(spark, base))


def _csv(spark, sf_dir, name):
    """Write a table as CSV files in two column orders, read them by header."""
    base, rows = scratch_path(spark, "csv"), testdata.star(spark, sf_dir)[name]
    odd = F.pmod(F.xxhash64(*STAR[name].key), F.lit(2)) == 1
    for mode, part, columns in (("error", odd, rows.columns), ("append", ~odd, rows.columns[::-1])):
        written = rows.filter(part).select(*columns).write.mode(mode).option("header", True)
        written.option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/{STAR[name].file}")
    return star.read_star_csv(spark, base, (name,))[name]


@query
def csv_scan(spark, sf_dir):
    return _csv(spark, sf_dir, "dim_customer")


@query
def csv_scan_device(spark, sf_dir):
    return _csv(spark, sf_dir, "dim_device")


@query
def csv_scan_transaction(spark, sf_dir):
    """With NULL scenarios, decimals and timestamps."""
    return _csv(spark, sf_dir, "fact_transaction")


@query
def pk_violations(spark, sf_dir):
    """Repeated (order, line) keys of lineitem, which does not declare them unique."""
    return integrity.key_violations(testdata.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def pk_violations_packed(spark, sf_dir):
    """The same by packed positions, without a shuffle of the keys."""
    return repeats.repeated_keys(testdata.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def event_key_report(spark, sf_dir):
    """Repeated event ids, and events of the same user at the same time: (keys, surplus rows) of each."""
    events = testdata.read(spark, sf_dir, "events")
    found = []
    for rule in ("event_id", "user_id,ts"):
        twice = repeats.repeated_keys(events, rule.split(","))
        found.append(
            twice.agg(F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"))
            .select(F.lit(rule).alias("rule"), "repeated_keys", "surplus_rows")
        )
    return reduce(DataFrame.unionByName, found)


@query
def fk_violations(spark, sf_dir):
    """Customers that no event refers to, as orphans of the event stream."""
    users = testdata.read(spark, sf_dir, "events").select("user_id")
    return integrity.orphan_keys(testdata.read(spark, sf_dir, "customer"), "c_custkey", users, "user_id")


@query
def key_report(spark, sf_dir):
    feats = _features(spark, sf_dir)
    scores = scoring.blend(_outputs(feats))
    tables = {**testdata.star(spark, sf_dir), "txn_features": feats, "txn_risk_scores": scores}
    return integrity.table_violations(tables, {**STAR, "txn_features": FEATURES, "txn_risk_scores": SCORES})


@query
def metric_key_report(spark, sf_dir):
    metrics = materialize(_metrics(spark, sf_dir), "metrics")
    tables = {
        "model_performance": evaluate.model_performance(metrics),
        "scenario_recall": evaluate.scenario_table(metrics),
    }
    return integrity.table_violations(
        tables, {"model_performance": MODEL_PERFORMANCE, "scenario_recall": SCENARIO_RECALL}
    )


@query
def check_violations(spark, sf_dir):
    return integrity.row_violations(_unfloored(spark, sf_dir), STAR, ("check",))


@query
def null_counts(spark, sf_dir):
    return integrity.row_violations(_unfloored(spark, sf_dir), STAR, ("not_null",))


@query
def limit_violations(spark, sf_dir):
    return integrity.row_violations(_unfloored(spark, sf_dir), STAR, ("limit",))


def _unfloored(spark, sf_dir):
    """The star schema as a raw feed would deliver it: amounts of cheap events
    turned negative, views without a channel, errors without a city and with
    the event type as an over-long state."""
    tables = testdata.star(spark, sf_dir)
    events = testdata.read(spark, sf_dir, "events").select(
        testdata.padded_key("TXN", F.col("event_id"), 8).alias("transaction_id"), "event_type", "value"
    )
    kind = F.col("event_type")
    raw = tables["fact_transaction"].join(events, "transaction_id").withColumns(
        {
            "amount": F.when(F.col("value") < 1, -F.col("amount")).otherwise(F.col("amount")).cast("decimal(12,2)"),
            "channel": F.when(kind == "view", None).when(kind == "signup", "kiosk").otherwise(F.col("channel")),
            "city": F.when(kind != "error", F.col("city")),
            "state": F.when(kind == "error", kind).otherwise(F.col("state")),
        }
    )
    return {**tables, "fact_transaction": raw.select(*STAR["fact_transaction"].schema.names)}


# ------------------------------------------------------------------- features


def _feature_columns(name: str, *columns: str) -> None:
    def run(spark, sf_dir):
        return portable(_features(spark, sf_dir).select("transaction_id", *columns))

    QUERIES[name] = run


_feature_columns("velocity_1h", "txn_count_1h", "amount_sum_1h")
_feature_columns("velocity_24h", "txn_count_24h", "amount_sum_24h")
_feature_columns("rolling_spend_7d", "avg_amount_7d")
_feature_columns("rolling_spend_30d", "avg_amount_30d")
_feature_columns("spend_ratio", "amount_to_avg_7d_ratio", "amount_to_avg_30d_ratio")
_feature_columns("txn_sequence", "customer_id", "customer_txn_seq")
_feature_columns("geo_jump", "minutes_since_prev_txn", "km_from_prev_txn")
_feature_columns("geo_velocity", "geo_velocity_kmh")
_feature_columns("km_from_home", "km_from_home")
_feature_columns("device_age", "device_age_hours")
_feature_columns("calendar_context", "hour_of_day", "day_of_week", "is_night", "is_online")


@query
def txn_features(spark, sf_dir):
    return _features(spark, sf_dir)


def _by_days(spark, sf_dir, held_back):
    """The feature table of three runs of ten days; rows that ``held_back`` picks come a run late."""
    fact, people, base = testdata.transactions(spark, sf_dir), testdata.customers(spark, sf_dir), scratch_path(spark, "daily")
    us = F.unix_micros(F.col("txn_timestamp").cast("timestamp"))
    first, last = fact.agg(F.min(us), F.max(us)).first()
    ends = [first + 10 * 86_400_000_000, first + 20 * 86_400_000_000, last + 1]
    for low, end in zip([first, *ends], ends, strict=False):
        due, early = (us >= low) & (us < end), (us < low) & (us >= low - 10 * 86_400_000_000)
        daily.add_day(base, fact.filter((due & ~held_back) | (early & held_back) if end < ends[-1] else due | (early & held_back)), people, end, fact)
    return daily.read_features(spark, base)


@query
def txn_features_daily(spark, sf_dir):
    """The same features built by runs of ten days, each from its own rows and the state before it."""
    return _by_days(spark, sf_dir, F.lit(False))


@query
def txn_features_late(spark, sf_dir):
    """The same features although some rows come a run late."""
    return _by_days(spark, sf_dir, F.pmod(F.xxhash64("transaction_id"), F.lit(50)) == 0)


@query
def order_spend_90d(spark, sf_dir):
    """Rolling spend per customer over seven years of orders, many per day."""
    orders = testdata.read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    out = rolling(orders, "o_custkey", "o_orderdate", "cents", 90 * 86_400, "o_orderkey")
    return out.select("o_orderkey", F.col("sum").alias("cents_90d"), F.col("count").alias("orders_90d"))


@query
def txn_features_sliced(spark, sf_dir):
    """The same features, with every customer of more than a few rows taken by slices."""
    return features(testdata.transactions(spark, sf_dir), testdata.customers(spark, sf_dir), hot_rows=3)


@query
def order_spend_90d_sliced(spark, sf_dir):
    orders = testdata.read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    out = rolling(orders, "o_custkey", "o_orderdate", "cents", 90 * 86_400, "o_orderkey", hot_rows=3, slice_rows=2_000)
    return out.select("o_orderkey", F.col("sum").alias("cents_90d"), F.col("count").alias("orders_90d"))


@query
def feature_validation(spark, sf_dir):
    feats = _features(spark, sf_dir)
    return validation.feature_validation(feats, testdata.transactions(spark, sf_dir))


@query
def feature_validation_bracketed(spark, sf_dir):
    """The medians by bracket and exact count, the way of long tables."""
    feats = _features(spark, sf_dir)
    return validation.feature_validation(feats, testdata.transactions(spark, sf_dir), direct_rows=1)


@query
def city_distance_pairs(spark, sf_dir):
    return validation.city_distances(testdata.transactions(spark, sf_dir), testdata.customers(spark, sf_dir))


def _home_points(spark, sf_dir, number):
    """A row per city that is somebody's home, with its point."""
    homes = testdata.customers(spark, sf_dir).groupBy(F.col("home_city").alias(f"city{number}"))
    return homes.agg(F.min("home_latitude").alias(f"lat{number}"), F.min("home_longitude").alias(f"lon{number}"))


def _purchase_points(spark, sf_dir, number):
    rows = testdata.transactions(spark, sf_dir)
    return rows.select(F.col("latitude").alias(f"lat{number}"), F.col("longitude").alias(f"lon{number}"))


@query
def far_city_pairs(spark, sf_dir):
    """Every two home cities at least 800 km apart, whether anyone bought there or not."""
    pairs = distance.pairs_beyond(_home_points(spark, sf_dir, 1), _home_points(spark, sf_dir, 2), 800.0)
    km = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return pairs.select(F.col("city1").alias("home_city"), F.col("city2").alias("city"), km.cast("decimal(9,1)").alias("km"))


@query
def close_purchase_points(spark, sf_dir):
    """Every two places of purchase at most 2 km apart, a place with itself not."""
    here, there = (_purchase_points(spark, sf_dir, k).distinct() for k in (1, 2))
    pairs = distance.pairs_within(here, there, 2.0)
    return pairs.filter("lat1 <> lat2 or lon1 <> lon2").select("lat1", "lon1", "lat2", "lon2", F.round(F.col("km") * 1000).cast("bigint").alias("metres"))


@query
def customers_by_distance(spark, sf_dir):
    """For every place of purchase, the customers who live at least 800 km away and those who live nearer."""
    homes = testdata.customers(spark, sf_dir).select(F.col("home_latitude").alias("lat2"), F.col("home_longitude").alias("lon2"))
    return distance.counts_beyond(_purchase_points(spark, sf_dir, 1), homes, 800.0)


@query
def purchases_by_distance(spark, sf_dir):
    """For every place of purchase, the purchases made at least 400 km away and those made nearer."""
    return distance.counts_beyond(_purchase_points(spark, sf_dir, 1), _purchase_points(spark, sf_dir, 2), 400.0)


@query
def dense_txn_key(spark, sf_dir):
    """Renumber the transactions over the global (time, customer) order, times cut to the second."""
    rows = testdata.transactions(spark, sf_dir).select(
        "transaction_id", "customer_id", F.date_trunc("second", "txn_timestamp").alias("txn_timestamp"),
        F.col("txn_timestamp").alias("exact"),
    )
    keyed = dense_key(rows, ["exact", "customer_id", "transaction_id"], "n")
    return keyed.select(
        "transaction_id", "txn_timestamp", testdata.padded_key("TXN", F.col("n"), 8).alias("dense_id")
    )


@query
def fraud_summary(spark, sf_dir):
    return validation.fraud_summary(testdata.transactions(spark, sf_dir))


@query
def table_totals(spark, sf_dir):
    tables = testdata.star(spark, sf_dir)
    return validation.table_totals(tables["dim_customer"], tables["dim_device"], tables["fact_transaction"])


# ------------------------------------------------------------ split and scores


@query
def split_summary(spark, sf_dir):
    return scoring.split_summary(_split(testdata.transactions(spark, sf_dir)))


@query
def pos_weight(spark, sf_dir):
    return scoring.positive_weight(_split(testdata.transactions(spark, sf_dir)).filter("dataset_split = 'train'"))


@query
def risk_scores(spark, sf_dir):
    return _scores(spark, sf_dir).drop("scored_at")


@query
def tier_counts(spark, sf_dir):
    return scoring.tier_counts(_scores(spark, sf_dir))


@query
def equal_volume_cut(spark, sf_dir):
    return evaluate.equal_volume_cut(_scored_test(spark, sf_dir))


@query
def anomaly_scaling(spark, sf_dir):
    """Clip and rescale by the train rows' median and maximum, two decimals."""
    raw = materialize(_split(_features(spark, sf_dir)).select("transaction_id", "dataset_split", "km_from_home"), "raw")
    train = raw.filter("dataset_split = 'train'")
    middle = exact_quantiles(train, [], ["km_from_home"]).scalar()
    top = train.agg(F.max("km_from_home").cast("double")).scalar()
    x = (F.col("km_from_home").cast("double") - middle) / (top - middle)
    scaled = F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)) * 100
    return raw.select("transaction_id", round_half_even(scaled * 100).cast("bigint").alias("hundredths"))


@query
def model_matrix(spark, sf_dir):
    return matrix.model_matrix(_features(spark, sf_dir))


# ---------------------------------------------------- fitted models (no SQL form)

SETTINGS = pipeline.Settings(valid_start=testdata.VALID_START, test_start=testdata.TEST_START)
_FITTED: dict[tuple, tuple[DataFrame, Ensemble, Ensemble]] = {}


def _fitted(spark, sf_dir):
    """Matrix and both models of a data folder at their full sizes, fitted again
    if the folder's files have changed or the stored matrix is gone."""
    key = _key(spark, sf_dir)
    if key not in _FITTED or not all(exists(spark, f) for f in _FITTED[key][0].inputFiles()[:1]):
        made, columns = pipeline.training_matrix(_features(spark, sf_dir), SETTINGS)
        _FITTED.clear()
        _FITTED[key] = (made, *pipeline.fit(made, columns, SETTINGS))
    return _FITTED[key]


@query
def isolation_scores(spark, sf_dir):
    made, model, _ = _fitted(spark, sf_dir)
    return forest.score_forest(made, model).select("transaction_id", "dataset_split", "isolation_anomaly_score")


@query
def boosted_scores(spark, sf_dir):
    made, _, model = _fitted(spark, sf_dir)
    return boost.score_boost(made, model).select("transaction_id", "dataset_split", "xgb_fraud_probability")


@query
def feature_importance(spark, sf_dir):
    return gain_share(_fitted(spark, sf_dir)[2], spark)


@query
def top_features(spark, sf_dir):
    return gain_share(_fitted(spark, sf_dir)[2], spark).limit(10)


@query
def fitted_properties(spark, sf_dir):
    """What must hold of the full-size fits on any data: (property, holds)."""
    made, isolation, boosted = _fitted(spark, sf_dir)
    scored = forest.score_forest(made.withColumn("_raw_depth", forest.anomaly(made, isolation)), isolation)
    scored = materialize(boost.score_boost(scored, boosted), "fitted")
    train, valid = (scored.filter(F.col("dataset_split") == part) for part in ("train", "valid"))
    score, p = F.col("isolation_anomaly_score"), F.col("xgb_fraud_probability").cast("double")
    low, high = isolation.params["median"], isolation.params["max"]
    seen = scored.agg(
        F.bool_and(score.between(0, 100)).alias("anomaly scores lie in 0 to 100"),
        F.bool_and(p.between(0, 1)).alias("probabilities lie in 0 to 1"),
        F.bool_and((F.col("_raw_depth") > low) | (score == 0)).alias("up to the train median an anomaly score is 0"),
        F.bool_and((F.col("_raw_depth") < high) | (score == 100)).alias("from the train maximum an anomaly score is 100"),
    )
    of_train = train.agg(
        (F.max("_raw_depth") == F.lit(high)).alias("the maximum is a train row's"),
        (F.abs(F.count_if(score == 0) / F.count(F.lit(1)) - 0.5) < 0.1).alias("about half the train rows score 0"),
    )
    base = valid.agg(F.avg(F.col("is_fraud").cast("int"))).first()[0]
    ranked = evaluate.ranking_quality(valid.withColumn("all", F.lit(1)), "is_fraud", "xgb_fraud_probability", "all")
    of_valid = ranked.select((F.col("pr_auc") > F.lit(base)).alias("average precision is above the base rate"))
    again = made.repartition(3)
    both = forest.score_forest(again, isolation).join(scored.select("transaction_id", score.alias("was")), "transaction_id")
    same = both.agg(F.bool_and(score == F.col("was")).alias("scores do not depend on the partitions"))
    gains = gain_share(boosted, spark).agg((F.abs(F.sum("importance") - 1) < 0.01).alias("importances sum to 1"))
    sizes = spark.range(1).select(
        F.lit(isolation.trees == forest.TREES).alias("the forest has all its trees"),
        F.lit(1 <= boosted.trees <= boost.MAX_TREES).alias("the number of boosted trees is allowed"),
    )
    long = lambda df: df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("property"), F.col(f"`{c}`").alias("holds")) for c in df.columns])))
    return reduce(DataFrame.unionByName, map(long, (seen, of_train, of_valid, same, gains, sizes)))


@query
def fitted_performance(spark, sf_dir):
    """Test-period metrics of the fitted models, as published."""
    scores = materialize(pipeline.score(*_fitted(spark, sf_dir)), "scores")
    tested = materialize(
        pipeline.test_rows(scores, testdata.transactions(spark, sf_dir), testdata.TEST_START), "scored_test"
    )
    return evaluate.model_performance(evaluate.evaluate(evaluate.policies(tested)))


# ------------------------------------------------------------------ evaluation


def _ranking(spark, sf_dir):
    return evaluate.ranking_quality(
        evaluate.policies(_scored_test(spark, sf_dir)), "is_fraud", "score", "model"
    )


@query
def roc_auc(spark, sf_dir):
    return _ranking(spark, sf_dir).select("model", "roc_auc")


@query
def average_precision(spark, sf_dir):
    return _ranking(spark, sf_dir).select("model", "pr_auc")


@query
def alert_policy_metrics(spark, sf_dir):
    return evaluate.alert_quality(
        evaluate.policies(_scored_test(spark, sf_dir)), "is_fraud", "flagged", "amount", "model"
    )


@query
def model_performance(spark, sf_dir):
    return evaluate.model_performance(_metrics(spark, sf_dir))


@query
def scenario_recall(spark, sf_dir):
    return evaluate.scenario_table(_metrics(spark, sf_dir))


@query
def metrics_json(spark, sf_dir):
    """Write the metrics as one JSON document, read it back, flatten it."""
    base = scratch_path(spark, "metrics_json")
    evaluate.metrics_document(_metrics(spark, sf_dir), flag_threshold=F.lit(60)).write.json(base)
    rows = evaluate.flatten_metrics(spark.read.schema(evaluate.METRICS_JSON).json(base))
    return evaluate.model_performance(rows)


@query
def scorecard(spark, sf_dir):
    return tiles.scorecard(evaluate.model_performance(_metrics(spark, sf_dir)))


@query
def model_vs_rule(spark, sf_dir):
    return tiles.model_vs_rule(evaluate.model_performance(_metrics(spark, sf_dir)))


@query
def scenario_matrix(spark, sf_dir):
    labels = [label for label, _ in evaluate.MODEL_LABELS.values()]
    short = dict(zip(labels, ("rule", "isolation", "boosted", "blend"), strict=True))
    return tiles.scenario_matrix(evaluate.scenario_table(_metrics(spark, sf_dir)), labels).withColumnsRenamed(short)


# ------------------------------------------------------------------- reporting


@query
def bi_fact(spark, sf_dir):
    return _bi_fact(spark, sf_dir)


@query
def bi_dim_customer(spark, sf_dir):
    return bi.bi_customer(testdata.customers(spark, sf_dir))


@query
def bi_dim_date(spark, sf_dir):
    return bi.bi_date(testdata.transactions(spark, sf_dir))


@query
def auto_calendar(spark, sf_dir):
    return cal.calendar(testdata.customers(spark, sf_dir), "signup_date")


@query
def txn_calendar(spark, sf_dir):
    """The second automatic date table, over the transactions' days."""
    return cal.calendar(testdata.transactions(spark, sf_dir), "txn_timestamp")


@query
def signups_by_quarter(spark, sf_dir):
    """The date hierarchy at quarter level, joined on the date part."""
    people = testdata.customers(spark, sf_dir)
    return cal.by_level(
        people, "signup_date", cal.calendar(people, "signup_date"), "Quarter", F.count(F.lit(1)).alias("customers")
    )


@query
def period_outcome(spark, sf_dir):
    return bi.period_outcome(_bi_fact(spark, sf_dir))


def _tile(name: str) -> None:
    def run(spark, sf_dir):
        return portable(tiles.tile(name, _model(spark, sf_dir)))

    QUERIES[name] = run


for _name in tiles.TILES:
    _tile(_name)


@query
def all_measures(spark, sf_dir):
    """Every measure per customer segment: a dimension axis."""
    parts = ("legit_transactions", "selected_version", "selected_period", "sum_amount", "sum_risk_score")
    return summarize(_model(spark, sf_dir), ["customer_segment"], [n for n in MEASURES if n not in parts])


@query
def sliced_kpi_cards(spark, sf_dir):
    """Overview cards with every overview slicer set."""
    slicers = {
        "channel": "Online",
        "customer_segment": ("Building", "Household"),
        "month_short": "Jan",
        "merchant_category": lambda c: c != "Gas",
    }
    return tiles.tile("kpi_cards", _model(spark, sf_dir), slicers)


@query
def kpi_cards_by_week(spark, sf_dir):
    """Overview cards over some of the weeks."""
    return tiles.tile("kpi_cards", _model(spark, sf_dir), {"week_start": lambda c: F.dayofmonth(c) > 15})


def _placed(df: DataFrame) -> DataFrame:
    """A report's rows with their place in the order in which they come."""
    come = df.withColumn("_come", F.monotonically_increasing_id())
    return dense_key(come, ["_come"], "position").drop("_come")


@query
def alert_queue_order(spark, sf_dir):
    return _placed(tiles.alert_queue(_model(spark, sf_dir)))


@query
def exposure_by_attack_order(spark, sf_dir):
    return _placed(tiles.tile("exposure_by_attack", _model(spark, sf_dir)))


@query
def scorecard_order(spark, sf_dir):
    return _placed(tiles.scorecard(evaluate.model_performance(_metrics(spark, sf_dir))))


@query
def feature_validation_order(spark, sf_dir):
    feats = _features(spark, sf_dir)
    return _placed(validation.feature_validation(feats, testdata.transactions(spark, sf_dir)))


@query
def calculate_override(spark, sf_dir):
    """A tier slicer does not reach the measure that fixes the tier itself, and
    a range slicer on the score reaches both; by tier and state."""
    filters = {**tiles.LIVE, "risk_tier": ("High", "Medium"), "anomaly_risk_score": between(30, 100)}
    names = ["critical_alerts", "flagged_alerts", "total_volume"]
    out = summarize(_model(spark, sf_dir), ["risk_tier", "state"], names, filters)
    return out.withColumns({n: F.col(n).cast("double") for n in names})


@query
def headline_row(spark, sf_dir):
    """Measures as one row under one filter, and the subtitle."""
    names = ["fraud_exposure", "fraud_prevented", "prevention_rate", "flagged_alerts", "alert_precision",
             "false_positive_rate", "report_subtitle"]
    return summarize(_model(spark, sf_dir), [], names, tiles.LIVE)


@query
def drill_through(spark, sf_dir):
    """Investigation cards reached from one fraud type and a set of states."""
    picked = {"fraud_type": "Impossible Travel", "state": ("03", "07", "11", "19")}
    return tiles.tile("investigation_cards", _model(spark, sf_dir), picked)


@query
def alert_queue(spark, sf_dir):
    return tiles.alert_queue(_model(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return tiles.confusion_matrix(_model(spark, sf_dir))


def _cube_model(spark: SparkSession, sf_dir: str, *names: str) -> cubes.CubeModel:
    """The reporting star with stored cubes: one period's parts are written first, the other's appended."""
    star_model, base = _model(spark, sf_dir), scratch_path(spark, "cubes")
    sets = {n: c for n, c in cubes.tile_cubes().items() if n in names}
    live = F.col("model_period") == tiles.LIVE_PERIOD
    for rows, mode in ((~live, "overwrite"), (live, "append")):
        cubes.write_cubes(tiles.StarModel(star_model.fact.filter(rows), star_model.dimensions), base, sets, mode)
    return cubes.CubeModel(star_model.fact, star_model.dimensions, cubes.read_cubes(spark, base, sets))


@query
def weekly_trend_cube(spark, sf_dir):
    return tiles.tile("weekly_trend", _cube_model(spark, sf_dir, "weekly_trend"))


@query
def exposure_by_attack_cube(spark, sf_dir):
    return tiles.tile("exposure_by_attack", _cube_model(spark, sf_dir, "exposure_by_attack"))


@query
def confusion_matrix_cube(spark, sf_dir):
    return tiles.confusion_matrix(_cube_model(spark, sf_dir, "weekly_trend"))


@query
def sketched_medians(spark, sf_dir):
    """Medians from stored sketches of days: (scenario, metric, holds), whether the rank of each is within its bound."""
    feats, fact = materialize(_features(spark, sf_dir), "features"), testdata.transactions(spark, sf_dir)
    sketches = materialize(validation.median_sketches(feats, fact), "sketches")
    ranks = validation.median_ranks(feats, fact, materialize(validation.sketched_validation(sketches), "sketched"))
    off = validation.SKETCH_ERROR
    return ranks.select("scenario", "metric", ((F.col("below") <= 0.5 + off) & (F.col("upto") >= 0.5 - off)).alias("holds"))


@query
def overview_slicers(spark, sf_dir):
    return tiles.slicer_options(_model(spark, sf_dir), tiles.SLICERS["overview"], tiles.LIVE)


@query
def investigation_slicers(spark, sf_dir):
    return tiles.slicer_options(_model(spark, sf_dir), tiles.SLICERS["investigation"], tiles.REVIEW)


# --------------------------------------------------------------------- extract


def _live(spark, sf_dir):
    m = _model(spark, sf_dir)
    customers, dates = m.dimensions["dim_customer"][0], m.dimensions["dim_date"][0]
    return export.live_rows(m.fact, customers, dates)


@query
def web_columns(spark, sf_dir):
    return export.web_columns(_live(spark, sf_dir))[0]


@query
def dictionary_codes(spark, sf_dir):
    return export.web_columns(_live(spark, sf_dir))[1]


@query
def dictionary_codes_long(spark, sf_dir):
    """The codes by range exchange, the way of long dictionaries."""
    return export.web_columns(_live(spark, sf_dir), short=0)[1]


@query
def web_alerts(spark, sf_dir):
    return export.web_alerts(_live(spark, sf_dir))
