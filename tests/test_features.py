import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.functions.exact import cents, micros
from riskloom.functions.geo import haversine_km
from riskloom.operators import history
from riskloom.plans.features import FRAMES, features
from riskloom.sources.schemas import FEATURES
from riskloom.storage import materialize
from tests.conftest import START

HOUR, DAY = 3600, 86400


def timed(fact):
    return fact.withColumns({"us": micros("txn_timestamp"), "cents": cents("amount")})


def by_id(df):
    return {r["transaction_id"]: r for r in df.collect()}


def test_schema(make_fact, customers):
    made = features(make_fact([{}]), customers)
    assert made.columns == FEATURES.schema.names
    assert [f.dataType for f in made.schema] == [f.dataType for f in FEATURES.schema]


def test_single_transaction_has_no_history(make_fact, customers):
    r = features(make_fact([{}]), customers).first()
    assert r.customer_txn_seq == 1 and r.txn_count_1h == 1 and r.device_age_hours == 0
    for c in ("avg_amount_7d", "amount_to_avg_30d_ratio", "minutes_since_prev_txn", "km_from_prev_txn", "geo_velocity_kmh"):
        assert r[c] is None


def test_same_time_rows_count_each_other(make_fact, customers):
    got = by_id(features(make_fact([{"amount": "1.00"}, {"amount": "3.00"}]), customers))
    assert [got[t].customer_txn_seq for t in ("T0000", "T0001")] == [1, 2]
    assert all(r.txn_count_1h == 2 and r.amount_sum_1h == 4 for r in got.values())
    assert float(got["T0000"].avg_amount_7d) == 3.0 and float(got["T0001"].avg_amount_7d) == 1.0
    assert got["T0001"].minutes_since_prev_txn == 0 and got["T0001"].geo_velocity_kmh == 0


@pytest.mark.parametrize("frame", list(FRAMES))
def test_frame_bounds(make_fact, customers, frame):
    width = FRAMES[frame]
    rows = [{"after": -1e-6}, {"after": 0}, {"after": width}]
    got = by_id(
        history.with_history(
            timed(make_fact(rows)), key="customer_id", us="us", row_id="transaction_id", value="cents", frames=FRAMES
        )
    )
    assert got["T0002"][f"cnt_{frame}"] == 2  # exactly `width` earlier counts, a microsecond more does not


def test_half_cent_average_rounds_up(make_fact, customers):
    rows = [{"amount": "0.01"}, {"amount": "0.02", "after": 1}, {"amount": "1.00", "after": 2}]
    r = by_id(features(make_fact(rows), customers))["T0002"]
    assert str(r.avg_amount_7d) == "0.02"  # 0.015
    assert str(r.amount_to_avg_7d_ratio) == "66.667"  # from the unrounded 0.015


def test_velocity_floor_and_distance(make_fact, customers):
    rows = [{}, {"after": 1, "longitude": 1.0}]
    r = by_id(features(make_fact(rows), customers))["T0001"]
    km = 6371 * math.pi / 180
    assert float(r.km_from_prev_txn) == round(km, 1)
    assert float(r.geo_velocity_kmh) == round(km * 60, 1)


def test_haversine_limits(spark):
    points = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0), (45.3, 7.7, 45.3, 7.7)], "a double, b double, c double, d double")
    got = [r[0] for r in points.select(haversine_km(*map(F.col, "abcd"))).collect()]
    assert got[:2] == pytest.approx([6371 * math.pi] * 2) and got[2] == 0


def test_device_age_uses_first_use_on_the_account(make_fact, customers):
    rows = [{"device_id": "D1"}, {"device_id": "D2", "after": HOUR}, {"device_id": "D1", "after": 90 * 60}]
    got = by_id(features(make_fact(rows), customers))
    assert [float(got[t].device_age_hours) for t in ("T0000", "T0001", "T0002")] == [0, 0, 1.5]


def _random_rows(n, seed=1):
    rng = random.Random(seed)
    return [
        {
            "customer_id": rng.choice(["C1", "C1", "C1", "C2", "C3"]),
            "device_id": rng.choice(["D1", "D2", "D3"]),
            "after": rng.choice([rng.randrange(0, 40 * DAY), rng.randrange(0, 3 * HOUR, 900)]),
            "amount": f"{rng.randrange(50, 90000) / 100:.2f}",
            "latitude": rng.uniform(-60, 60),
            "longitude": rng.uniform(-170, 170),
        }
        for _ in range(n)
    ]


def test_frames_against_brute_force(make_fact):
    fact = make_fact(_random_rows(250))
    data = [(r.transaction_id, r.customer_id, r.txn_timestamp, int(r.amount * 100)) for r in fact.collect()]
    got = by_id(
        history.with_history(
            timed(fact), key="customer_id", us="us", row_id="transaction_id", value="cents", frames=FRAMES
        )
    )
    for i, c, t, _ in data:
        for frame, seconds in FRAMES.items():
            near = [v for _, k, u, v in data if k == c and t - timedelta(seconds=seconds) <= u <= t]
            assert (got[i][f"sum_{frame}"], got[i][f"cnt_{frame}"]) == (sum(near), len(near))


@pytest.mark.parametrize("slice_rows", [7, 60, 100_000])
def test_sliced_keys_equal_whole_keys(make_fact, customers, monkeypatch, slice_rows):
    """Keys above the limit take the sliced route; results must not change."""
    fact = make_fact(_random_rows(300, seed=2))
    monkeypatch.setitem(history.with_history.__kwdefaults__, "slice_rows", slice_rows)
    whole = sorted(features(fact, customers).collect())
    assert sorted(features(fact, customers, hot_rows=80).collect(), key=str) == sorted(whole, key=str)
    assert sorted(features(fact, customers, hot_rows=0).collect(), key=str) == sorted(whole, key=str)


def test_sliced_route_without_broadcast(make_fact, customers, monkeypatch):
    fact = make_fact(_random_rows(200, seed=3))
    whole = sorted(features(fact, customers).collect(), key=str)
    monkeypatch.setattr(history, "BROADCAST_ROWS", 0)
    monkeypatch.setitem(history.with_history.__kwdefaults__, "slice_rows", 50)
    assert sorted(features(fact, customers, hot_rows=30).collect(), key=str) == whole


def test_no_future_leaks(make_fact, customers):
    fact = make_fact(_random_rows(200, seed=4))
    cut = START + timedelta(days=10)
    early = by_id(features(fact.filter(F.col("txn_timestamp") < cut), customers))
    full = by_id(features(fact, customers))
    assert early and all(full[t] == r for t, r in early.items())


def test_partition_count_does_not_matter(spark, make_fact, customers):
    fact = make_fact(_random_rows(200, seed=5))
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(features(fact.repartition(int(n)), customers, hot_rows=90).collect(), key=str))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_ratio_beyond_64_bits(spark):
    from riskloom.functions.exact import ratio_milli

    rows = [(10**11, 3 * 10**16, 10**6), (999, 10**18, 10**15), (5, 0, 0)]
    df = spark.createDataFrame(rows, "v long, s long, n long")
    got = [r[0] for r in df.select(ratio_milli(F.col("v"), F.col("s"), F.col("n"))).collect()]
    assert got == [(2000 * v * n + s) // (2 * s) if s else None for v, s, n in rows]


def test_one_shuffle_of_the_fact(spark, make_fact, customers):
    """Sequence, frames and device first use share one exchange on the customer."""
    text = features(make_fact(_random_rows(20)), F.broadcast(customers))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_generated_code_is_compiled(spark, make_fact, customers):
    """The JVM interprets methods over 8,000 bytes; also with a sort-merge join."""
    import contextlib
    import io
    import re

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as text:
            features(make_fact(_random_rows(5)), customers).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000


def test_zone_less_times_ignore_the_session_zone(spark, make_fact, customers):
    """Over a change to summer time, under two session zones."""
    rows = [("T1", "2026-03-08 01:30:00"), ("T2", "2026-03-08 02:30:00"), ("T3", "2026-03-08 03:30:00.5"), ("T4", "1969-12-31 23:59:59")]
    fact = make_fact([{"transaction_id": i, "latitude": float(k)} for k, (i, _) in enumerate(rows)])
    times = F.create_map(*[F.lit(x) for r in rows for x in r])
    out = {}
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            timed = fact.withColumn("txn_timestamp", times[F.col("transaction_id")].cast("timestamp_ntz"))
            out[zone] = sorted(features(timed, customers).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out["UTC"] == out["America/New_York"]
    third = next(r for r in out["UTC"] if r.transaction_id == "T3")
    assert (str(third.minutes_since_prev_txn), third.hour_of_day, third.day_of_week) == ("60.0", 3, 0)
    assert str(third.txn_timestamp) == "2026-03-08 03:30:00.500000"


def test_median_sketches_day_by_day(spark):
    """Sketches of days, each from its own rows, against exact ranks; enough rows that a sketch must compact."""
    from riskloom.plans import validation

    n = 60_000
    rows = spark.range(n).selectExpr(
        "cast(id as string) AS transaction_id", "id % 7 = 0 AS is_night", "cast((id * 7919) % 100003 / 7 as decimal(12,2)) AS amount",
        "IF(id % 10 = 0, NULL, pow((id * 31) % 1009, 3)) AS amount_to_avg_30d_ratio", "cast(id % 3 as int) AS txn_count_1h",
        "cast(5 as int) AS txn_count_24h", "cast(NULL as double) AS geo_velocity_kmh", "sqrt(id) AS km_from_home", "-id * 0.5 AS device_age_hours",
    )
    fact = spark.range(n).selectExpr(
        "cast(id as string) AS transaction_id", "timestamp '2026-01-01' + make_dt_interval(cast(id % 5 as int)) AS txn_timestamp",
        "IF(id % 4 = 0, 'ring', NULL) AS fraud_scenario",
    )
    whole = validation.median_sketches(rows, fact)
    days = [validation.median_sketches(rows, fact.filter(F.to_date("txn_timestamp") == f"2026-01-0{d}")) for d in range(1, 6)]
    union = days[0]
    for d in days[1:]:
        union = union.unionByName(d)
    for sketches in (whole, union):
        got = materialize(validation.sketched_validation(sketches), "sketched")
        exact = validation.feature_validation(rows, fact)
        assert [(r.scenario, r.txns, r.night_share, r.med_geo_kmh) for r in got.collect()] == [
            (r.scenario, r.txns, r.night_share, r.med_geo_kmh) for r in exact.collect()
        ]
        ranks = validation.median_ranks(rows, fact, got).collect()
        assert len(ranks) == 2 * 6
        assert all(r.below <= 0.5 + validation.SKETCH_ERROR and r.upto >= 0.5 - validation.SKETCH_ERROR for r in ranks)
