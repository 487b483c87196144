"""Great-circle distance as a column expression (stays in generated code)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius.
EARTH_RADIUS_M = 6_371_000.0
EARTH_RADIUS_KM = 6_371.0


def haversine(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_M) -> Column:
    """Distance between two points in the unit of `radius`; arguments are degrees."""
    lat1, lon1, lat2, lon2 = (F.col(c) if isinstance(c, str) else c for c in (lat1, lon1, lat2, lon2))
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
