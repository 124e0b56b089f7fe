"""Distances on the globe."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371  # fixed value


def haversine_km(latitude_1: Column, longitude_1: Column, latitude_2: Column, longitude_2: Column) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    half_sine_lat = F.sin(F.radians(latitude_2 - latitude_1) / 2)
    half_sine_lon = F.sin(F.radians(longitude_2 - longitude_1) / 2)
    chord = F.pow(half_sine_lat, F.lit(2)) + (
        F.cos(F.radians(latitude_1)) * F.cos(F.radians(latitude_2)) * F.pow(half_sine_lon, F.lit(2))
    )
    # Rounding can lift opposite points just above 1, where asin is undefined.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))
