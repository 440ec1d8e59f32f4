"""Reports that check the data and the features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.geo import haversine_km
from riskloom.operators.ordering import DIRECT_ROWS, exact_quantiles
from riskloom.storage import materialize

MEDIANS = {
    "amount": "med_amount",
    "amount_to_avg_30d_ratio": "med_ratio_30d",
    "txn_count_1h": "med_count_1h",
    "txn_count_24h": "med_count_24h",
    "geo_velocity_kmh": "med_geo_kmh",
    "km_from_home": "med_km_home",
    "device_age_hours": "med_device_age_h",
}


def share(hits, total, digits: int):
    """hits / total, rounded half away from zero from exact integers."""
    return F.round(hits.cast("decimal(19,0)") / F.nullif(total, F.lit(0)).cast("decimal(19,0)"), digits)


def feature_validation(features: DataFrame, fact: DataFrame, direct_rows: int = DIRECT_ROWS) -> DataFrame:
    """Does each fraud scenario stand out on the feature meant to catch it:
    exact medians and the share of night rows per scenario, largest first."""
    scenario = fact.select("transaction_id", F.coalesce("fraud_scenario", F.lit("legit")).alias("scenario"))
    rows = features.select("transaction_id", "is_night", *MEDIANS).join(scenario, "transaction_id")
    rows = materialize(rows.drop("transaction_id"), "validation")
    sizes = rows.groupBy("scenario").agg(
        F.count(F.lit(1)).alias("txns"),
        share(F.count_if("is_night"), F.count(F.lit(1)), 3).cast("decimal(6,3)").alias("night_share"),
    )
    medians = exact_quantiles(rows, ["scenario"], list(MEDIANS), direct_rows=direct_rows).withColumnsRenamed(MEDIANS)
    return (
        sizes.join(medians, "scenario", "left")
        .select("scenario", "txns", *MEDIANS.values(), "night_share")
        .orderBy(F.desc("txns"), "scenario")
    )


#: Size of a median sketch and the share of the rows by which its rank may be off, twice the sketch's own bound.
SKETCH_K, SKETCH_ERROR = 1_000, 0.01


def median_sketches(features: DataFrame, fact: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per day and scenario: transactions, night rows and a mergeable sketch of every feature with a median. Kept as a
    table, a new day adds its own rows and reads no others."""
    days = fact.select(
        "transaction_id", F.to_date("txn_timestamp").alias("day"), F.coalesce("fraud_scenario", F.lit("legit")).alias("scenario")
    )
    rows = features.select("transaction_id", "is_night", *MEDIANS).join(days, "transaction_id")
    return rows.groupBy("day", "scenario").agg(
        F.count(F.lit(1)).alias("txns"), F.count_if("is_night").alias("nights"),
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(name) for c, name in MEDIANS.items()],
    )


def sketched_validation(sketches: DataFrame) -> DataFrame:
    """:func:`feature_validation` with approximate medians, values that occur, from stored sketches of any days."""
    merged = sketches.groupBy("scenario").agg(
        F.sum("txns").alias("txns"), share(F.sum("nights"), F.sum("txns"), 3).cast("decimal(6,3)").alias("night_share"),
        *[F.kll_merge_agg_double(name).alias(name) for name in MEDIANS.values()],
    )
    middle = lambda c: F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(0.5)))
    return merged.select(
        "scenario", "txns", *[middle(c).alias(c) for c in MEDIANS.values()], "night_share"
    ).orderBy(F.desc("txns"), "scenario")


def median_ranks(features: DataFrame, fact: DataFrame, medians: DataFrame) -> DataFrame:
    """(scenario, metric, below, upto): shares of the values under, and not over, each median of ``medians``."""
    scenario = fact.select("transaction_id", F.coalesce("fraud_scenario", F.lit("legit")).alias("scenario"))
    rows = features.select("transaction_id", *MEDIANS).join(scenario, "transaction_id")
    rows = rows.join(medians.select("scenario", *MEDIANS.values()), "scenario")
    value = lambda c: F.col(c).cast("double")
    counts = rows.groupBy("scenario").agg(
        *[
            F.struct(
                F.lit(name).alias("metric"), (F.count_if(value(c) < F.col(name)) / F.nullif(F.count(c), F.lit(0))).alias("below"),
                (F.count_if(value(c) <= F.col(name)) / F.nullif(F.count(c), F.lit(0))).alias("upto"),
            ).alias(f"_{name}")
            for c, name in MEDIANS.items()
        ]
    )
    ranks = F.array(*[f"_{name}" for name in MEDIANS.values()])
    return counts.select("scenario", F.explode(ranks).alias("r")).select("scenario", "r.*").filter("upto IS NOT NULL")


def fraud_summary(fact: DataFrame) -> DataFrame:
    """Rows, mean and total amount of each fraud scenario."""
    total = F.sum("amount")
    return (
        fact.filter("is_fraud")
        .groupBy("fraud_scenario")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.round(total / F.count("amount"), 2).cast("decimal(18,2)").alias("avg_amount"),
            total.alias("total"),
        )
        .orderBy("fraud_scenario")
    )


def table_totals(customers: DataFrame, devices: DataFrame, fact: DataFrame) -> DataFrame:
    """One row: table sizes, untrusted devices, time span, volume, fraud share."""
    people = customers.agg(F.count(F.lit(1))).scalar()
    gear = devices.agg(
        F.struct(F.count(F.lit(1)).alias("all"), F.count_if(~F.col("is_trusted")).alias("untrusted"))
    ).scalar()
    rows, fraud = F.count(F.lit(1)), F.count_if("is_fraud")
    totals = fact.agg(
        rows.alias("transactions"),
        F.min("txn_timestamp").alias("first_txn"),
        F.max("txn_timestamp").alias("last_txn"),
        fraud.alias("fraud_rows"),
        F.sum("amount").alias("total_volume"),
        F.sum(F.when(F.col("is_fraud"), F.col("amount"))).alias("fraud_volume"),
        share(fraud, rows, 4).cast("decimal(6,4)").alias("fraud_share"),
    )
    return totals.select(
        people.alias("customers"),
        gear.getField("all").alias("devices"),
        gear.getField("untrusted").alias("untrusted_devices"),
        *totals.columns,
    )


def city_distances(fact: DataFrame, customers: DataFrame, min_km: float = 800.0) -> DataFrame:
    """Home city and purchase city at least ``min_km`` apart, with their
    distance and the transactions between them. Only pairs that occur are
    formed: transactions are counted per pair before any city is looked up."""
    homes = customers.select("customer_id", "home_city")
    pairs = (
        fact.groupBy("customer_id", "city").agg(F.count(F.lit(1)).alias("n"))
        .join(homes, "customer_id")
        .groupBy("home_city", "city")
        .agg(F.sum("n").alias("txns"))
    )
    centres = customers.groupBy("home_city").agg(
        F.min("home_latitude").alias("lat"), F.min("home_longitude").alias("lon")
    )
    near = centres.select("home_city", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"))
    # A city that is nobody's home lies where its purchases were made.
    seen = fact.groupBy("city").agg(F.min("latitude").alias("lat"), F.min("longitude").alias("lon"))
    far = seen.alias("s").join(centres.alias("c"), F.col("s.city") == F.col("c.home_city"), "left").select(
        "s.city", F.coalesce("c.lat", "s.lat").alias("lat2"), F.coalesce("c.lon", "s.lon").alias("lon2")
    )
    km = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return (
        pairs.join(near, "home_city")
        .join(far, "city")
        .withColumn("exact_km", km)
        .filter(F.col("exact_km") >= min_km)
        .select("home_city", "city", F.col("exact_km").cast("decimal(9,1)").alias("km"), "txns")
    )
