"""Column functions over coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def valid_pair(lat: Column, lng: Column) -> tuple[Column, Column]:
    """Coordinates as doubles; both null if either is missing, no number or 0."""
    lat, lng = lat.try_cast("double"), lng.try_cast("double")
    good = lat.isNotNull() & lng.isNotNull() & (lat != 0) & (lng != 0)
    return F.when(good, lat), F.when(good, lng)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in kilometres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * (2 * EARTH_KM)
