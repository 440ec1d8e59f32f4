"""Features day by day against the full build."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riskloom.plans import daily
from riskloom.plans.features import features
from tests.conftest import START

DAY = 86_400


def micros_of(days):
    return int((START + timedelta(days=days) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


@pytest.fixture
def fact(make_fact):
    rnd = random.Random(9)
    rows = []
    for k in range(260):
        after = rnd.choice((rnd.uniform(0, 70 * DAY), rnd.randrange(70) * DAY, rnd.randrange(35) * 2 * DAY + 3600 * rnd.randrange(25)))
        rows.append(
            {"transaction_id": f"T{k:04d}", "customer_id": rnd.choice(("C1", "C1", "C2", "C3", "C9")), "device_id": f"D{rnd.randrange(5)}",
             "after": after, "amount": f"{rnd.randrange(1, 90_000) / 100:.2f}", "latitude": rnd.uniform(-60, 60), "longitude": rnd.uniform(-170, 170),
             "is_fraud": rnd.random() < 0.2, "channel": rnd.choice(("online", "in_store"))}
        )
    # One customer is away for longer than the longest frame, with an old device and a long-known place.
    rows += [{"transaction_id": f"U{k}", "customer_id": "C2", "device_id": "D9", "after": d * DAY} for k, d in enumerate((0, 0, 65, 65.5))]
    return make_fact(rows).cache()


def part(fact, low, high):
    us = F.unix_micros("txn_timestamp")
    return fact.filter((us >= micros_of(low)) & (us < micros_of(high)))


def table(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


ENDS = (0, 9, 10, 33, 50, 71)


@pytest.mark.parametrize("hot_rows", [5_000_000, 6])
def test_days_equal_the_full_build(spark, fact, customers, tmp_path, hot_rows):
    base = str(tmp_path / "daily")
    for low, high in zip(ENDS, ENDS[1:], strict=False):
        daily.add_day(base, part(fact, low, high), customers, micros_of(high), hot_rows=hot_rows)
    got, want = daily.read_features(spark, base), features(fact, customers)
    assert got.schema.simpleString() == want.schema.simpleString() and table(got) == table(want)
    assert daily.late_rows(spark, base).count() == 0
    state = daily._state(spark, base, micros_of(71))
    assert state["recent"].agg(F.min("ts_us")).first()[0] >= micros_of(41)


def test_a_stopped_or_repeated_day(spark, fact, customers, tmp_path, monkeypatch):
    base = str(tmp_path / "daily")
    daily.add_day(base, part(fact, 0, 33), customers, micros_of(33))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily, "_joined", lost)  # features are written, the state is not
        with pytest.raises(RuntimeError):
            daily.add_day(base, part(fact, 33, 50), customers, micros_of(50))
    assert daily.days(spark, base) == [micros_of(33)]
    assert table(daily.read_features(spark, base)) == table(features(part(fact, 0, 33), customers))
    for _ in range(2):
        daily.add_day(base, part(fact, 33, 71), customers, micros_of(71))
    assert table(daily.read_features(spark, base)) == table(features(fact, customers))
    with pytest.raises(ValueError):
        daily.add_day(base, part(fact, 0, 1), customers, micros_of(1))
    with pytest.raises(ValueError):
        daily.add_day(base, part(fact, 33, 71), customers, micros_of(72) - 40 * DAY * 1_000_000 + 0)


def test_late_rows(spark, fact, customers, tmp_path):
    held = F.col("transaction_id").isin("T0003", "T0050", "U1") & (F.unix_micros("txn_timestamp") < micros_of(33))
    late = {r[0] for r in fact.filter(held).select("transaction_id").collect()}
    assert late
    for whole in (True, False):
        base = str(tmp_path / f"daily{whole}")
        daily.add_day(base, part(fact, 0, 33).filter(~held), customers, micros_of(33))
        second = part(fact, 33, 50).unionByName(fact.filter(held))
        day = daily.add_day(base, second, customers, micros_of(50), fact if whole else None)
        assert (day.late, day.rebuilt) == (len(late), whole)
        daily.add_day(base, part(fact, 50, 71), customers, micros_of(71))
        assert {r.transaction_id for r in daily.late_rows(spark, base).collect()} == late
        want = features(fact if whole else fact.filter(~held), customers)
        assert table(daily.read_features(spark, base)) == table(want)


def test_empty_day(spark, fact, customers, tmp_path):
    base = str(tmp_path / "daily")
    daily.add_day(base, fact.limit(0), customers, micros_of(1))
    daily.add_day(base, fact.limit(0), customers, micros_of(2))
    assert daily.read_features(spark, base).count() == 0
