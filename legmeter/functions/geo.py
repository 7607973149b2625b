"""Coordinates: exact join keys and straight-line distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in metres, and the key resolution of about 0.1 m.
EARTH_RADIUS_M = 6371008.8
MICRO = 1_000_000


def micro_degrees(degrees: Column) -> Column:
    """A degree value as a whole number of millionths, so that joins never compare doubles."""
    return F.round(degrees * MICRO).cast("long")


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.sin(half_lat) * F.sin(half_lat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(
        half_lon
    ) * F.sin(half_lon)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord))
