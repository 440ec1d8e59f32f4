"""Star schema derived from the provided ``events``, ``customer`` and ``nation``
tables: one event is one transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom import storage
from riskloom.functions.labels import padded_key
from riskloom.sources.schemas import MERCHANT_CATEGORIES, STAR

# Cutoffs that give the provided 30 days a train, valid and test part.
VALID_START = "2024-01-16"
TEST_START = "2024-01-21"

SCENARIOS = {
    95: "friendly_fraud", 96: "card_testing", 97: "high_value_spend",
    98: "account_takeover", 99: "impossible_travel",
}
DEVICE_TYPES = ("mobile_ios", "mobile_android", "desktop_web")


def _pick(number: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (number % len(values) + 1).cast("int"))


# Declared types of the provided tables, so that no job has to read them from a file first.
_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    source = spark.read.schema(_SCHEMAS[table]) if table in _SCHEMAS else spark.read
    return source.parquet(f"{sf_dir}/{table}.parquet")


def version(spark: SparkSession, sf_dir: str) -> tuple:
    """Tells the present files of the star's tables from any others."""
    return storage.version(spark, [f"{sf_dir}/{table}.parquet" for table in _SCHEMAS])


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key, home = F.col("c_custkey"), F.col("c_nationkey")
    days = (key % 2900).cast("int")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        padded_key("C", key, 6).alias("customer_id"),
        F.col("n_name").alias("home_city"),
        padded_key("", home, 2).alias("home_state"),
        (F.lit(24.0) + F.lit(0.9) * home).alias("home_latitude"),
        (F.lit(-120.0) + F.lit(2.1) * home).alias("home_longitude"),
        (F.lit(18) + key % 60).cast("smallint").alias("age"),
        F.lower("c_mktsegment").alias("customer_segment"),
        F.date_add(F.lit("2015-01-01").cast("date"), days).alias("signup_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k, home, event, user = F.col("k"), F.col("c_nationkey"), F.col("event_id"), F.col("user_id")
    spend = F.when(k == 96, F.lit(1.0)).when(k == 97, F.col("value") * F.lit(8.0)).otherwise(F.col("value"))
    scenario = F.lit(None).cast("string")
    for code, name in SCENARIOS.items():
        scenario = F.when(k == code, name).otherwise(scenario)
    jitter = lambda factor: ((event * factor) % 81 - 40) / F.lit(1000.0)
    place = F.col("place")
    rows = (
        e.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        .join(c, user == F.col("c_custkey"))
        .withColumn("place", F.when((k >= 98) | (k < 3), (home + 7) % 25).otherwise(home))
        .join(n, place == F.col("n_nationkey"))
    )
    return rows.select(
        padded_key("TXN", event, 8).alias("transaction_id"),
        padded_key("C", user, 6).alias("customer_id"),
        F.when(k.isin(96, 98, 99), padded_key("X", event, 7))
        .otherwise(padded_key("D", user * 3 + event % 3, 7))
        .alias("device_id"),
        F.col("ts").cast("timestamp").alias("txn_timestamp"),
        F.greatest(spend, F.lit(0.5)).cast("decimal(12,2)").alias("amount"),
        _pick(k, MERCHANT_CATEGORIES).alias("merchant_category"),
        F.when(k % 2 == 0, "online").otherwise("in_store").alias("channel"),
        F.col("n_name").alias("city"),
        padded_key("", place, 2).alias("state"),
        (F.lit(24.0) + F.lit(0.9) * place + jitter(37)).alias("latitude"),
        (F.lit(-120.0) + F.lit(2.1) * place + jitter(53)).alias("longitude"),
        (k >= 95).alias("is_fraud"),
        scenario.alias("fraud_scenario"),
    )


def devices(transactions: DataFrame) -> DataFrame:
    suffix = F.substring("device_id", 2, 20).cast("bigint")
    return (
        transactions.groupBy("device_id", "customer_id")
        .agg(F.min("txn_timestamp").alias("first_seen_at"))
        .select(
            "device_id",
            "customer_id",
            _pick(suffix, DEVICE_TYPES).alias("device_type"),
            "first_seen_at",
            (~F.col("device_id").startswith("X")).alias("is_trusted"),
        )
    )


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    txns = transactions(spark, sf_dir)
    tables = {"dim_customer": customers(spark, sf_dir), "dim_device": devices(txns), "fact_transaction": txns}
    return {name: tables[name].select(*spec.schema.names) for name, spec in STAR.items()}
