"""Distance on the sphere as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat_a: Column, lng_a: Column, lat_b: Column, lng_b: Column) -> Column:
    """Great-circle distance in km; null when a coordinate is null."""
    half_lat = (F.radians(lat_b) - F.radians(lat_a)) / 2
    half_lng = (F.radians(lng_b) - F.radians(lng_a)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.pow(F.sin(half_lng), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))
