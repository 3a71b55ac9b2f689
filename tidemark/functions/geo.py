"""Distances and speeds on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance. The root is clamped: rounding may push it above 1 at antipodes."""
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2))
    half_lng = F.pow(F.sin(F.radians(lng2 - lng1) / 2), F.lit(2))
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def elapsed_hours(later: Column, earlier: Column) -> Column:
    """Whole-second difference in hours, at least one second."""
    seconds = F.unix_timestamp(later) - F.unix_timestamp(earlier)
    return F.greatest(seconds / F.lit(3600.0), F.lit(1 / 3600.0))
