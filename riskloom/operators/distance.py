"""Distance joins on the sphere, by cells.

Latitude is cut into bands and each band into cells about as wide as it is high.
Points at most R km apart lie in neighbouring cells of a grid of that size: a
left point goes to the few cells its circle can touch, a right point to its own,
and an equality join does the rest. For points at least R km apart, pairs of cells
are judged by their centres and radii: cells too near are dropped, cells far enough
are taken whole, and only the cells between need the points' distances.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, degrees

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.geo import EARTH_RADIUS_KM, haversine_km
from riskloom.storage import materialize

#: Height of the cells by which far pairs are judged, in degrees: about 1,150 cells, so cell pairs do not grow with the points.
FAR_CELL = 6.0
_SLACK_KM = 1e-6  # bounds are doubles
_LEAST_STEP = 1e-4


def _in_band(band: Column, step: float) -> Column:
    """How many cells a band has: as many steps as fit its longest circle."""
    low = band * F.lit(step) - 90.0
    nearest = F.when((low <= 0) & (low + step >= 0), 0.0).otherwise(F.least(F.abs(low), F.abs(low + step)))
    return F.greatest(F.floor(360.0 * F.cos(F.radians(nearest)) / step), F.lit(1)).cast("int")


def _band(lat: Column, step: float) -> Column:
    return F.greatest(F.least(F.floor((lat + 90.0) / step), F.lit(ceil(180 / step) - 1)), F.lit(0)).cast("int")


def _cell(lon: Column, cells: Column) -> Column:
    return F.least(F.floor(F.pmod(lon, F.lit(360.0)) * cells / 360.0), cells - 1).cast("int")


def _in_cells(df: DataFrame, lat: str, lon: str, step: float, names: Sequence[str]) -> DataFrame:
    """``df`` with the band and cell of each point; rows without a point go."""
    band = _band(F.col(lat), step)
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumns(
        {names[0]: band, names[1]: _cell(F.col(lon), _in_band(band, step))}
    )


def pairs_within(left: DataFrame, right: DataFrame, km: float, name: str = "km") -> DataFrame:
    """All columns of both sides and the distance, for each pair of points at most ``km`` apart.

    Sides have columns of different names; points are ``lat1``, ``lon1`` and ``lat2``, ``lon2`` in degrees. Rows
    without a point have no pairs, equal points and repeated rows all do."""
    reach = degrees((km + _SLACK_KM) / EARTH_RADIUS_KM)
    step = min(max(reach, _LEAST_STEP), 90.0)
    lat, lon = F.col("lat1"), F.col("lon1")
    bands = F.sequence(_band(lat - F.lit(reach), step), _band(lat + F.lit(reach), step))
    # The circle's widest half in longitude; around a pole it is the whole circle.
    polar = F.abs(lat) + reach >= 90.0
    half = F.when(polar, 180.0).otherwise(
        F.degrees(F.asin(F.least(F.sin(F.radians(F.lit(min(reach, 90.0)))) / F.cos(F.radians(lat)), F.lit(1.0)))) + 1e-9
    )
    cells = F.col("_cells")
    first, last = (F.floor((F.pmod(lon, F.lit(360.0)) + s * F.col("_half")) * cells / 360.0).cast("int") for s in (-1, 1))
    around = F.when(last - first + 1 >= cells, F.sequence(F.lit(0), cells - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda c: F.pmod(c, cells))
    )
    reached = (
        left.filter(lat.isNotNull() & lon.isNotNull())
        .withColumn("_half", half)
        .withColumn("_band", F.explode(bands))
        .withColumn("_cells", _in_band(F.col("_band"), step))
        .withColumn("_cell", F.explode(around))
        .drop("_half", "_cells")
    )
    at = _in_cells(right, "lat2", "lon2", step, ("_band", "_cell"))
    distance = haversine_km(lat, lon, F.col("lat2"), F.col("lon2"))
    return reached.join(at, ["_band", "_cell"]).withColumn(name, distance).filter(F.col(name) <= km).drop("_band", "_cell")


def _centre(band: Column, cell: Column, step: float) -> tuple[Column, Column, Column]:
    """Latitude and longitude of a cell's middle, and the km within which all of it lies."""
    cells = _in_band(band, step)
    low = band * F.lit(step) - 90.0
    high = F.least(low + step, F.lit(90.0))
    lat, lon = (low + high) / 2, (cell + 0.5) * 360.0 / cells
    half = F.lit(180.0) / cells
    corner = F.greatest(*[haversine_km(lat, F.lit(0.0), edge, half) for edge in (low, high)])
    # A band of one cell lies around a pole: no two of its points are further apart than over the pole.
    across = 2 * (90.0 - F.least(F.abs(low), F.abs(high))) * F.lit(EARTH_RADIUS_KM * 3.141592653589793 / 180)
    return lat, lon, F.when(cells == 1, across).otherwise(corner)


def _cell_pairs(left: DataFrame, right: DataFrame, km: float, step: float) -> DataFrame:
    """(_b1, _c1, _b2, _c2, _whole): pairs of cells, both with points, that hold pairs at least ``km`` apart; in whole
    ones all are. Each left cell is held against the fixed list of cells, not against rows."""
    mine = left.select("_b1", "_c1").distinct()
    all_bands = F.explode(F.sequence(F.lit(0), F.lit(ceil(180 / step) - 1)))
    against = mine.withColumn("_b2", all_bands).withColumn("_c2", F.explode(F.sequence(F.lit(0), _in_band(F.col("_b2"), step) - 1)))
    lat1, lon1, r1 = _centre(F.col("_b1"), F.col("_c1"), step)
    lat2, lon2, r2 = _centre(F.col("_b2"), F.col("_c2"), step)
    judged = against.select(
        "_b1", "_c1", "_b2", "_c2", haversine_km(lat1, lon1, lat2, lon2).alias("_d"), (r1 + r2 + 2 * _SLACK_KM).alias("_r")
    ).filter(F.col("_d") + F.col("_r") >= km)
    held = right.select("_b2", "_c2").distinct()
    return judged.join(held, ["_b2", "_c2"]).select("_b1", "_c1", "_b2", "_c2", (F.col("_d") - F.col("_r") >= km).alias("_whole"))


def pairs_beyond(left: DataFrame, right: DataFrame, km: float, step: float = FAR_CELL) -> DataFrame:
    """All columns of both sides for each pair of points at least ``km`` apart; points as in :func:`pairs_within`.
    Pairs of whole cells are taken without a distance."""
    mine = _in_cells(left, "lat1", "lon1", step, ("_b1", "_c1"))
    theirs = _in_cells(right, "lat2", "lon2", step, ("_b2", "_c2"))
    cells = materialize(_cell_pairs(mine, theirs, km, step), "cell-pairs")
    met = mine.join(cells, ["_b1", "_c1"]).join(theirs, ["_b2", "_c2"])
    distance = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    return met.filter(F.col("_whole") | (distance >= km)).drop("_b1", "_c1", "_b2", "_c2", "_whole")


def counts_beyond(left: DataFrame, right: DataFrame, km: float, step: float = FAR_CELL) -> DataFrame:
    """(lat1, lon1, beyond, within): for each distinct point of ``left``, how many rows of ``right`` lie at least ``km``
    away, and how many nearer. No pair is formed with a cell that is far enough: its count is added. Rows without a
    point count nowhere."""
    points = left.filter(F.col("lat1").isNotNull() & F.col("lon1").isNotNull()).select("lat1", "lon1").distinct()
    mine = materialize(_in_cells(points, "lat1", "lon1", step, ("_b1", "_c1")), "left-points")
    folded = right.filter(F.col("lat2").isNotNull() & F.col("lon2").isNotNull()).groupBy("lat2", "lon2").agg(F.count(F.lit(1)).alias("_n"))
    theirs = materialize(_in_cells(folded, "lat2", "lon2", step, ("_b2", "_c2")), "right-points")
    cells = materialize(_cell_pairs(mine, theirs, km, step), "cell-pairs")
    sizes = theirs.groupBy("_b2", "_c2").agg(F.sum("_n").alias("_n"))
    far = cells.filter("_whole").join(sizes, ["_b2", "_c2"]).groupBy("_b1", "_c1").agg(F.sum("_n").alias("_n"))
    whole = mine.join(far, ["_b1", "_c1"]).select("lat1", "lon1", "_n")
    distance = haversine_km(F.col("lat1"), F.col("lon1"), F.col("lat2"), F.col("lon2"))
    some = (
        mine.join(cells.filter("not _whole"), ["_b1", "_c1"]).join(theirs, ["_b2", "_c2"])
        .filter(distance >= km).select("lat1", "lon1", "_n")
    )
    beyond = whole.unionAll(some).groupBy("lat1", "lon1").agg(F.sum("_n").alias("_n"))
    total = theirs.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    count = F.coalesce("_n", F.lit(0))
    everyone = F.lit(total.first()[0])
    return mine.select("lat1", "lon1").join(beyond, ["lat1", "lon1"], "left").select(
        "lat1", "lon1", count.alias("beyond"), (everyone - count).alias("within")
    )
