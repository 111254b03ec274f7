"""Great-circle distance as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values the results depend on.
EARTH_RADIUS_KM = 6371.0
ARRIVAL_THRESHOLD_KM = 0.0005


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance between two points in degrees; NULL if any coordinate is NULL."""
    half_lat = (F.radians(lat2) - F.radians(lat1)) / 2
    half_lon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_lat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    # Rounding can lift the chord a hair above 1 at antipodes, where sqrt(1 - chord) would be NaN.
    rest = F.greatest(1.0 - chord, F.lit(0.0))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(rest))
