"""Distance joins against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import distance


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    t = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(t)))


@pytest.fixture(scope="module")
def points():
    rnd = random.Random(5)
    out = [(math.degrees(math.asin(rnd.uniform(-1, 1))), rnd.uniform(-180, 180)) for _ in range(150)]
    out += [(rnd.uniform(86, 90), rnd.uniform(-180, 180)) for _ in range(40)] + [(rnd.uniform(-90, -87), rnd.uniform(0, 360)) for _ in range(40)]
    out += [(rnd.uniform(-2, 2), rnd.choice((179.5, -179.5, 180.0, -180.0, 0.0, 360.0)) + rnd.uniform(-1, 1)) for _ in range(60)]
    out += [(90.0, 0.0), (-90.0, 10.0), (0.0, 0.0), (0.0, 180.0), (0.0, -180.0), (48.0, 6.0), (6.0, 6.0), (-6.0, 12.0)]
    return out + out[:3]


def sides(spark, points):
    rows = [(i, *p) for i, p in enumerate(points)] + [(-1, None, 1.0), (-2, 1.0, None)]
    made = [spark.createDataFrame(rows, f"id{k} int, lat{k} double, lon{k} double").repartition(3) for k in (1, 2)]
    return made


@pytest.mark.parametrize("reach", [3.0, 800.0, 13_000.0])
def test_both_directions_are_all_pairs(spark, points, reach):
    left, right = sides(spark, points)
    exact = {(i, j): km(a, b) for i, a in enumerate(points) for j, b in enumerate(points)}
    clear = lambda d: abs(d - reach) > 1e-7  # the last bit of a distance is the engine's
    near = {(r.id1, r.id2): r.km for r in distance.pairs_within(left, right, reach).collect()}
    assert {p for p in near if clear(exact[p])} == {p for p, d in exact.items() if d <= reach and clear(d)}
    assert all(d == pytest.approx(exact[p], abs=1e-6) for p, d in near.items())
    far = [(r.id1, r.id2) for r in distance.pairs_beyond(left, right, reach).collect()]
    assert len(far) == len(set(far))
    assert {p for p in far if clear(exact[p])} == {p for p, d in exact.items() if d >= reach and clear(d)}
    counted = {(r.lat1, r.lon1): (r.beyond, r.within) for r in distance.counts_beyond(left, right, reach).collect()}
    if reach > 0:
        for i, p in enumerate(points):
            ds = [exact[i, j] for j in range(len(points))]
            if all(map(clear, ds)):
                assert counted[p] == (sum(d >= reach for d in ds), sum(d < reach for d in ds))


def test_no_cartesian_product_and_no_points(spark, points):
    left, right = sides(spark, points)
    for df in (distance.pairs_within(left, right, 800), distance.pairs_beyond(left, right, 800), distance.counts_beyond(left, right, 800)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert df.filter(F.lit(False)).count() == 0
    none = left.filter("id1 is null")
    assert distance.pairs_within(none, right, 800).count() == distance.pairs_beyond(none, right, 800).count() == 0
    assert {r.within for r in distance.counts_beyond(left, right.filter("id2 < 0"), 800).collect()} == {0}
