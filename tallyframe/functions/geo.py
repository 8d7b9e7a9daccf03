"""Distances on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: radius of the earth in miles used by the distance formula.
EARTH_MILES = 3963.0


def great_circle_miles(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Spherical law of cosines on degrees; the cosine is kept within [-1, 1]."""
    a, b = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(long2) - F.radians(long1))
    return F.lit(EARTH_MILES) * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
