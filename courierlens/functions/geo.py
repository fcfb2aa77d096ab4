"""Column expressions over positions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from courierlens.params import BIN_BASE_METRES, BIN_STEPS, EARTH_RADIUS_KM


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in kilometres."""
    lat1, lat2 = F.radians(lat1), F.radians(lat2)
    half_lat = F.pow(F.sin((lat2 - lat1) / 2), 2)
    half_lon = F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    chord = half_lat + F.cos(lat1) * F.cos(lat2) * half_lon
    # rounding may push the chord of antipodes over 1, where asin is NaN
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def metres_between(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    return haversine_km(lon1, lat1, lon2, lat2) * 1000


def whole_metres(metres: Column) -> Column:
    """Nearest metre, halves to the even neighbour."""
    return F.bround(metres, 0).cast("long")


def distance_bin(metres: Column, base: int = BIN_BASE_METRES, steps: tuple[int, ...] = BIN_STEPS) -> Column:
    """Number of bin edges at or below the distance; negative distances are an error."""
    bin_ = F.when(metres < 0, F.raise_error(F.lit("distance should be non-negative")).cast("int"))
    for i, step in enumerate(steps):
        bin_ = bin_.when(metres < step * base, F.lit(i))
    return bin_.when(metres.isNotNull(), F.lit(len(steps)))
