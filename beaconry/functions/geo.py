"""Great-circle distance as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371
KM_PER_DEGREE = 111.19492664455873  # pi * 6371 / 180


def _as_column(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def distance_from_haversine(h: Column) -> Column:
    """Rounding can push the term past 1, where ASIN is NaN, hence the clamp; unknown stays unknown."""
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_as_column, (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return distance_from_haversine(h)
