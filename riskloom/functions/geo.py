"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points; NULL if a coordinate is. The haversine
    term is held at 1: a rounding excess there would make ``asin`` return NaN."""
    half_lat = F.sin(F.radians(lat2 - lat1) / F.lit(2.0))
    half_lon = F.sin(F.radians(lon2 - lon1) / F.lit(2.0))
    term = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    root = F.sqrt(term)
    # Not least(): that skips NULLs and would place a missing point half a globe away.
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.when(root > 1.0, 1.0).otherwise(root))
