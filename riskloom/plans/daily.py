"""The feature table day by day.

A day needs of the past, per customer: how many rows there were, the last one, the
first use of each device, and the rows of the longest frame. That is the state, a
few tables written whole for each day and named by the day's end; a day joins its
rows with the state of its own customers and reads nothing older. A day that is
run again, or was stopped half way, starts from the state before it.

A row older than the state's end is late: everything its customer did since would
change. Late rows are named; given the whole fact, their customers are built anew
and replace what was published for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.history import HOT_ROWS
from riskloom.plans.features import FRAMES, behaviour, feature_columns, history_rows, is_zoneless
from riskloom.storage import exists

_FRAME_US = max(FRAMES.values()) * 1_000_000
_ROW = "transaction_id string, customer_id string, device_id string, ts_us bigint, cents bigint, latitude double, longitude double"
_CUSTOMER = "customer_id string, rows bigint, last struct<ts_us: bigint, transaction_id: string, latitude: double, longitude: double>"
_DEVICE = "customer_id string, device_id string, first_us bigint"
_TABLES = {"recent": _ROW, "customers": _CUSTOMER, "devices": _DEVICE}
_RECENT = [c.strip().split(" ")[0] for c in _ROW.split(",")]


@dataclass(frozen=True)
class Day:
    """What a day's run published: ends in microseconds, and how many rows were late."""

    upto_us: int
    late: int
    rebuilt: bool


def _state(spark: SparkSession, base: str, upto_us: int | None) -> dict[str, DataFrame]:
    if upto_us is None:
        return {name: spark.createDataFrame([], schema) for name, schema in _TABLES.items()}
    return {name: spark.read.schema(schema).parquet(f"{base}/state/{upto_us}/{name}") for name, schema in _TABLES.items()}


def days(spark: SparkSession, base: str) -> list[int]:
    """Ends of the days that are complete, earliest first; one small row each."""
    if not exists(spark, f"{base}/days"):
        return []
    return sorted(r[0] for r in spark.read.schema("upto_us bigint").parquet(f"{base}/days").distinct().collect())


def _state_of(rows: DataFrame) -> dict[str, DataFrame]:
    last = F.struct("ts_us", "transaction_id", "latitude", "longitude")
    return {
        "recent": rows.select(*_RECENT),
        "customers": rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("rows"), F.max(last).alias("last")),
        "devices": rows.groupBy("customer_id", "device_id").agg(F.min("ts_us").alias("first_us")),
    }


def _joined(old: dict[str, DataFrame], new: dict[str, DataFrame], upto_us: int) -> dict[str, DataFrame]:
    both = {name: old[name].unionByName(new[name]) for name in _TABLES}
    return {
        # Rows that a frame of any later row may still reach.
        "recent": both["recent"].filter(F.col("ts_us") >= upto_us - _FRAME_US),
        "customers": both["customers"].groupBy("customer_id").agg(F.sum("rows").alias("rows"), F.max("last").alias("last")),
        "devices": both["devices"].groupBy("customer_id", "device_id").agg(F.min("first_us").alias("first_us")),
    }


def _day_features(rows: DataFrame, state: dict[str, DataFrame], customers: DataFrame, zoneless: bool, hot_rows: int) -> DataFrame:
    """Features of a day's ``rows``, later than all of the state."""
    own = rows.select("customer_id").distinct()
    past = state["recent"].join(own, "customer_id", "left_semi")
    missing = [c for c in rows.columns if c not in _RECENT]
    past = past.select(*_RECENT, *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in missing], F.lit(False).alias("_new"))
    history = behaviour(rows.withColumn("_new", F.lit(True)).unionByName(past), customers, hot_rows).filter("_new")
    # Rows before the frame are known by their number, last row and first uses only.
    counted = past.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_held"))
    known = state["customers"].join(own, "customer_id", "left_semi").join(counted, "customer_id", "left")
    known = known.select("customer_id", (F.col("rows") - F.coalesce("_held", F.lit(0))).alias("_older"), F.col("last").alias("_last"))
    used = state["devices"].join(own, "customer_id", "left_semi").withColumnRenamed("first_us", "_first")
    history = history.join(known, "customer_id", "left").join(used, ["customer_id", "device_id"], "left")
    from_state = F.col("prev_ts_us").isNull()
    return feature_columns(
        history.withColumns(
            {
                "seq": F.col("seq") + F.coalesce("_older", F.lit(0)),
                **{f"prev_{c}": F.when(from_state, F.col(f"_last.{c}")).otherwise(F.col(f"prev_{c}")) for c in ("latitude", "longitude", "ts_us")},
                "first_use_us": F.least("first_use_us", "_first"),
            }
        ),
        zoneless,
    )


def add_day(
    base: str, day: DataFrame, customers: DataFrame, upto_us: int, fact: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> Day:
    """Publish the features of ``day``'s transactions, all before ``upto_us`` (microseconds, excluded), and the state
    after them. ``fact``, all transactions with the day's, is read for customers with late rows only; without it late
    rows are named in ``late`` and left out. Transactions of unknown customers have no features, as in the full build."""
    spark = day.sparkSession
    done = days(spark, base)
    before = max((d for d in done if d < upto_us), default=None)
    if any(d > upto_us for d in done):
        raise ValueError(f"days up to {done[-1]} are published already")
    rows, zoneless = history_rows(day), is_zoneless(day)
    is_late = F.lit(False) if before is None else F.col("ts_us") < before
    seen = rows.agg(F.count_if(is_late), F.coalesce(F.max("ts_us"), F.lit(0))).first()
    if seen[1] >= upto_us:
        raise ValueError("a row is at or after the day's end")
    state, late, rebuilt = _state(spark, base, before), rows.filter(is_late), False
    place = lambda name: f"{base}/{name}/upto_us={upto_us}"
    late.select("transaction_id", "customer_id", "ts_us").write.mode("overwrite").parquet(place("late"))
    on_time = rows.filter(~is_late)
    redone = spark.createDataFrame([], "customer_id string")
    if seen[0] and fact is not None:
        redone, rebuilt = spark.read.parquet(place("late")).select("customer_id").distinct(), True
        whole = history_rows(fact).filter(F.col("ts_us") < upto_us).join(redone, "customer_id", "left_semi")
        on_time = on_time.join(redone, "customer_id", "left_anti")
        state = {name: table.join(redone, "customer_id", "left_anti") for name, table in state.items()}
    made = _day_features(on_time, state, customers, zoneless, hot_rows)
    after = _state_of(on_time)
    if rebuilt:
        made = made.unionByName(feature_columns(behaviour(whole, customers, hot_rows), zoneless))
        after = {name: after[name].unionByName(table) for name, table in _state_of(whole).items()}
    made.write.mode("overwrite").parquet(place("features"))
    redone.write.mode("overwrite").parquet(place("rebuilt"))
    for name, table in _joined(state, after, upto_us).items():
        table.write.mode("overwrite").parquet(f"{base}/state/{upto_us}/{name}")
    # The day is complete once its end is listed.
    if upto_us not in done:
        spark.createDataFrame([(upto_us,)], "upto_us bigint").coalesce(1).write.mode("append").parquet(f"{base}/days")
    return Day(upto_us, int(seen[0]), rebuilt)


def _of_days(spark: SparkSession, base: str, name: str) -> DataFrame:
    paths = [f"{base}/{name}/upto_us={d}" for d in days(spark, base)]
    return spark.read.option("basePath", f"{base}/{name}").parquet(*paths)


def read_features(spark: SparkSession, base: str) -> DataFrame:
    """The feature table over all complete days, customers that were built anew by their last build."""
    rows, redone = _of_days(spark, base, "features"), _of_days(spark, base, "rebuilt")
    since = redone.groupBy("customer_id").agg(F.max("upto_us").alias("_since"))
    out = rows.join(since, "customer_id", "left").filter(F.col("_since").isNull() | (F.col("upto_us") >= F.col("_since")))
    return out.select(*[c for c in rows.columns if c != "upto_us"])


def late_rows(spark: SparkSession, base: str) -> DataFrame:
    """(transaction_id, customer_id, ts_us, upto_us): rows that came after their day, and the day they came with."""
    return _of_days(spark, base, "late")
