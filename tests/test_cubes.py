import pytest
from pyspark.sql import functions as F

from riskloom.catalog import queries
from riskloom.functions.labels import LIVE_PERIOD
from riskloom.plans import cubes, tiles
from riskloom.plans.measures import StarModel, measures, summarize
from tests.conftest import DATA


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    """The star and the same star with cubes, of which the live period's parts were appended to the other's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    star, base = queries._model(spark, DATA), str(tmp_path_factory.mktemp("cubes"))
    sets = cubes.tile_cubes()
    live = F.col("model_period") == LIVE_PERIOD
    for rows, mode in ((~live, "overwrite"), (live, "append")):
        cubes.write_cubes(StarModel(star.fact.filter(rows), star.dimensions), base, sets, mode)
    return star, cubes.CubeModel(star.fact, star.dimensions, cubes.read_cubes(spark, base, sets))


def same(a, b):
    assert a.schema == b.schema
    rows = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in map(tuple, df.collect()))
    key = lambda rs: [tuple(map(str, r)) for r in rs]
    assert key(sorted(rows(a), key=str)) == key(sorted(rows(b), key=str))


def reads(df):
    return {f.split("/")[-2] if "=" not in f.split("/")[-2] else f.split("/")[-3] for f in df.inputFiles()}


@pytest.mark.parametrize("name", sorted(set(tiles.TILES) - {"risk_scatter"}))
def test_tiles_read_a_cube_only(models, name):
    star, cubed = models
    t = tiles.tile(name, cubed)
    assert not {"bi_fact_transactions"} & reads(t) and len(reads(t)) == 1
    same(t, tiles.tile(name, star))


@pytest.mark.parametrize(
    ("name", "filters"),
    [
        ("kpi_cards", {"channel": "Online"}), ("kpi_cards", {"customer_segment": ["Standard", "Premium"], "merchant_category": "Gas"}),
        ("weekly_trend", {"month_short": "Jan"}), ("alerts_by_hour", {"state": "CA", "risk_tier": ("High", "Low")}),
        ("exposure_by_attack", {"is_fraud": True, "outcome": "Fraud Missed"}), ("investigation_cards", {"risk_tier": "Critical"}),
        ("kpi_cards", {"week_start": lambda c: F.dayofmonth(c) > 15}), ("band_counts", {"risk_tier": "none"}),
    ],
)
def test_slicers(models, name, filters):
    star, cubed = models
    got = tiles.tile(name, cubed, filters)
    assert "bi_fact_transactions" not in reads(got)
    same(got, tiles.tile(name, star, filters))


def test_every_measure_and_what_no_cube_holds(models):
    star, cubed = models
    for axes, filters in ((["customer_segment"], {}), ([], tiles.LIVE), (["risk_tier"], {"risk_tier": ["High", "Low"]})):
        same(summarize(cubed, axes, list(measures()), filters), summarize(star, axes, list(measures()), filters))
    same(tiles.confusion_matrix(cubed), tiles.confusion_matrix(star))
    same(tiles.slicer_options(cubed, tiles.SLICERS["overview"]), tiles.slicer_options(star, tiles.SLICERS["overview"]))
    far = tiles.tile("risk_scatter", cubed)  # as fine as the fact
    assert "bi_fact_transactions" in reads(far)
    same(far, tiles.tile("risk_scatter", star))
    with pytest.raises(ValueError, match="stat"):
        summarize(cubed, [], ["total_transactions"], {"stat": "A"})
    small = min(cubed.cubes, key=lambda c: c.rows)
    assert reads(summarize(cubed, [], ["total_transactions"])) == reads(small.table)
