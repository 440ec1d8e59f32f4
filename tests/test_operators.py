import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import dictionary, ordering, repeats
from riskloom.operators.calendar import calendar, date_spine, dim_date
from riskloom.operators.integrity import key_violations, orphan_keys, violations
from riskloom.sources.schemas import STAR


def test_dense_key_is_consecutive_in_order(spark):
    rng = random.Random(0)
    rows = [(rng.choice([1, 1, 1, 2, rng.randrange(1000)]), i) for i in range(2000)]
    rng.shuffle(rows)
    got = ordering.dense_key(spark.createDataFrame(rows, "a long, b long").repartition(7), ["a", "b"], "k", start=0)
    keyed = sorted((r.k, r.a, r.b) for r in got.collect())
    assert [k for k, _, _ in keyed] == list(range(2000))
    assert [(a, b) for _, a, b in keyed] == sorted(rows)


@pytest.mark.parametrize(("q", "direct"), [(0.0, 0), (0.25, 0), (0.5, 0), (0.5, 10**6), (0.987, 0), (1.0, 10**6)])
def test_quantiles_match_numpy(spark, monkeypatch, q, direct):
    monkeypatch.setattr(ordering, "DIRECT_ROWS", direct)
    rng = np.random.default_rng(3)
    groups = {
        "big": np.concatenate([rng.normal(0, 50, 3000), np.full(2000, 1.25)]),
        "fine": rng.uniform(0.40001, 0.40002, 501),
        "one": np.array([-7.5]),
        "two": np.array([1.0, 2.0]),
    }
    rows = [(g, float(v), None if i % 3 else float(-v)) for g, vs in groups.items() for i, v in enumerate(vs)]
    got = ordering.exact_quantiles(spark.createDataFrame(rows, "g string, v double, w double"), ["g"], ["v", "w"], q)
    for r in got.collect():
        assert r.v == pytest.approx(np.quantile(groups[r.g], q), rel=1e-12)
        assert r.w == pytest.approx(np.quantile(-groups[r.g][::3], q), rel=1e-12)


def test_quantile_outside_its_bracket(spark, monkeypatch):
    """A sketch that misses costs a second search, not the result."""
    df = spark.createDataFrame([(float(i),) for i in range(2001)], "v double")
    monkeypatch.setattr(ordering, "DIRECT_ROWS", 0)
    monkeypatch.setattr(ordering, "_ACCURACY", 3)
    real = ordering.F.percentile_approx
    monkeypatch.setattr(ordering.F, "percentile_approx", lambda c, ends, n: real(c, [0.9, 0.95], 1000))
    assert ordering.exact_quantiles(df, [], ["v"], 0.5).first()[0] == 1000.0


def test_quantile_of_null_group_and_scalar(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0)], "g string, v double")
    assert {r.g: r.v for r in ordering.exact_quantiles(df, ["g"], ["v"]).collect()} == {None: 2.0, "x": 5.0}
    share = df.agg(F.lit(1.0) - F.count_if(F.col("v") > 2) / F.count(F.lit(1))).scalar()
    assert ordering.exact_quantiles(df, [], ["v"], share).first()[0] == pytest.approx(np.quantile([1, 3, 5], 1 / 3))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = random.Random(5)
    hist = {(g, v): rng.randrange(5) for g in "ab" for v in {rng.uniform(-3, 900) for _ in range(200)}}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in hist.items()], "g string, v double, n long")
    for r in ordering.running_totals(df, ["g"], "v", ["n"], descending).collect():
        ahead = [n for (g, v), n in hist.items() if g == r.g and (v >= r.v if descending else v <= r.v)]
        assert r.n_upto == sum(ahead)
        assert r.n_all == sum(n for (g, _), n in hist.items() if g == r.g)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_dictionary_codes(spark, monkeypatch, limit):
    """The route for dictionaries too large for one window gives the same codes."""
    monkeypatch.setattr(dictionary, "BROADCAST_ROWS", limit)
    df = spark.createDataFrame([("b", "y", 1), ("a", "z", 2), ("b", None, 3)], "p string, q string, n long")
    coded, table = dictionary.dictionary_encode(df, ["p", "q"])
    assert sorted((r.n, r.p, r.q) for r in coded.collect()) == [(1, 1, 1), (2, 0, 2), (3, 1, 0)]
    assert sorted((r.dimension, r.code, r.value) for r in table.collect()) == [
        ("p", 0, "a"), ("p", 1, "b"), ("q", 0, None), ("q", 1, "y"), ("q", 2, "z"),
    ]


def test_dates(spark):
    one = spark.range(1)
    days = dim_date(date_spine(one, F.lit("2026-01-01"), F.lit("2026-06-30")))
    assert days.count() == 181
    r = days.filter("date = '2026-01-04'").first()  # a Sunday
    assert (str(r.week_start), r.day_of_week_number, r.day_name, r.is_weekend) == ("2025-12-29", 7, "Sun", True)
    cal = calendar(spark.sql("SELECT timestamp '2023-05-05 10:00:00' AS t UNION SELECT timestamp '2024-02-02 00:00:00'"), "t")
    assert cal.count() == 365 + 366
    assert cal.filter("Date = '2024-12-31'").first().Quarter == "Qtr 4"


def test_integrity_rules(spark, make_fact):
    people = spark.createDataFrame(
        [("C1", "Rome", "IT", 1.0, 1.0, 30, "standard", None), ("C1", "Oslo", "NOR", 1.0, 1.0, 30, "standard", None)],
        "customer_id string, home_city string, home_state string, home_latitude double, home_longitude double, "
        "age short, customer_segment string, signup_date date",
    )
    gear = spark.createDataFrame([("D1", "C9", "desktop_web", None, True)], STAR["dim_device"].schema)
    fact = make_fact(
        [{"amount": "0.00"}, {"amount": None, "channel": None}, {"channel": "phone"}, {"device_id": None}, {"device_id": "D7"}]
    )
    tables = {"dim_customer": people, "dim_device": gear, "fact_transaction": fact}
    broken = {(r.table_name, r.kind, r.rule): r.violations for r in violations(tables, STAR).collect() if r.violations}
    assert broken == {
        ("dim_customer", "primary_key", "customer_id"): 1,
        ("dim_customer", "not_null", "signup_date"): 2,
        ("dim_customer", "limit", "home_state"): 1,
        ("dim_device", "foreign_key", "customer_id->dim_customer"): 1,
        ("dim_device", "not_null", "first_seen_at"): 1,
        ("fact_transaction", "foreign_key", "device_id->dim_device"): 1,
        ("fact_transaction", "not_null", "amount"): 1,
        ("fact_transaction", "not_null", "channel"): 1,
        ("fact_transaction", "not_null", "device_id"): 1,
        ("fact_transaction", "check", "amount_positive"): 1,
        ("fact_transaction", "check", "channel_known"): 1,
    }
    assert [tuple(r) for r in key_violations(people, ["customer_id"]).collect()] == [("C1", 2)]
    assert [tuple(r) for r in orphan_keys(fact, "device_id", gear, "device_id").collect()] == [("D7", 1)]


@pytest.mark.parametrize("held", [50, 1 << 23])
def test_repeated_keys_by_packed_positions(spark, monkeypatch, held):
    """Nulls, a key with a third of the rows, many buckets, clashing column names, a grid too small for the keys."""
    rnd = random.Random(8)
    rows = [(f"k{rnd.randrange(900)}", rnd.randrange(3), i) for i in range(1200)]
    rows += [("hot", 1, i) for i in range(600)] + [(None, 1, 0), (None, 1, 1), (None, None, 0), ("", None, 0)]
    df = spark.createDataFrame(rows, "_at string, bucket int, once long").repartition(5)
    want = sorted(map(str, key_violations(df, ["_at", "bucket"]).collect()))
    monkeypatch.setattr(repeats, "BUCKET_KEYS", 100)
    for room, chance in ((64, 1 << 16), (1, 1 << 40), (64, 1)):
        monkeypatch.setattr(repeats, "ROOM", room)
        monkeypatch.setattr(repeats, "CHANCE_MEETINGS", chance)
        got = repeats.repeated_keys(df, ["_at", "bucket"], held)
        assert sorted(map(str, got.collect())) == want
    assert repeats.repeated_keys(df.limit(0), ["bucket"]).count() == 0
    monkeypatch.setattr(repeats, "BROADCAST_ROWS", 3)
    assert sorted(map(str, repeats.repeated_keys(df, ["_at", "bucket"], held).collect())) == want


def test_keys_without_repeats_cost_little(spark):
    """Well below a tenth of a row of 24 bytes with its key and count; no pair of different keys is expected to meet often."""
    keys = spark.range(1_000_000).select(F.sha1(F.col("id").cast("string")).alias("key"))
    buckets, places = repeats.grid(1_000_000)
    lists = repeats.position_lists(keys, ["key"], buckets, places)
    assert lists.select(F.sum(F.octet_length("once") + F.octet_length("twice"))).first()[0] < 1.6e6
    assert repeats.repeated_keys(keys, ["key"]).count() == 0
    for n in (0, 1, 10**6, 10**9, 10**12, 10**15):
        buckets, places = repeats.grid(n)
        assert 1 <= buckets * places <= 1 << 63 and buckets <= repeats.MOST_BUCKETS


def test_number_too_wide_for_its_declaration(spark):
    from riskloom.operators.integrity import row_rules

    df = spark.createDataFrame([("12345678901.00",), ("1.00",)], "amount string")
    broken = row_rules(STAR["fact_transaction"])["limit"]["amount_precision"]
    assert df.filter(broken).count() == 1


def test_value_bins_are_monotone_and_fine(spark):
    import numpy as np

    from riskloom.operators.ordering import value_bin

    rng = np.random.default_rng(4)
    values = sorted({0.0, 1.0, 2.0, -1.0, 5e-324, 1.7e308, 0.5, np.nextafter(1, 0), np.nextafter(2, 3), *rng.normal(size=200) * 1e-6, *10.0 ** rng.uniform(-300, 300, 500)})
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for finer in (1, 4096):
        got = [r[0] for r in df.orderBy("x").select(value_bin(F.col("x"), finer)).collect()]
        assert got == sorted(got)
    small = spark.range(100_000).select((F.col("id") * 1e-8).alias("x")).groupBy(value_bin(F.col("x")).alias("b")).count()
    assert small.agg(F.max("count")).first()[0] < 1_500


def test_one_instant_is_cut_into_slices(spark, monkeypatch):
    from riskloom.operators import history

    sizes = []
    whole = history._sliced

    def seen(*given):
        cut = whole(*given)
        sizes.append((given[3], cut.groupBy("_slice").count().agg(F.max("count")).first()[0]))
        return cut

    monkeypatch.setattr(history, "_sliced", seen)
    rows = spark.range(20_000).select(F.lit("k").alias("k"), F.lit(7).cast("bigint").alias("us"), F.col("id").alias("r"), F.lit(2).cast("bigint").alias("v"), F.col("id").alias("c"))
    out = history.with_history(rows, key="k", us="us", row_id="r", value="v", frames={"w": 1}, previous=("c",), hot_rows=10, slice_rows=2_000)
    got = out.agg(F.min("sum_w"), F.max("sum_w"), F.min("cnt_w"), F.count_distinct("seq"), F.max("seq"), F.count_if(F.col("prev_c") != F.col("c") - 1), F.count_if(F.col("prev_c").isNull())).first()
    assert tuple(got) == (40_000, 40_000, 20_000, 20_000, 20_000, 0, 1)
    assert dict(sizes)["slices"] <= 4_000 and dict(sizes)["instants"] <= 2


def test_slices_stay_few_until_they_are_large():
    from riskloom.operators import history

    assert [history.slices_for(n, 2_000) for n in (0, 300_000, 18_000_000, 10**10, 10**12)] == [1, 150, 1_000, 5_000, 50_000]
    assert history.slices_for(18_000_000, history.SLICE_ROWS) == 9
