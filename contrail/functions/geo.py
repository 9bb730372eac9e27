"""Great-circle helpers (X3, X4) as column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius used by the reference, in km.
EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    la1, lo1, la2, lo2 = (F.radians(_c(v)) for v in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a))


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from point 1 to point 2, degrees in [0, 360)."""
    la1, la2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlon = F.radians(_c(lon2) - _c(lon1))
    x = F.sin(dlon) * F.cos(la2)
    y = F.cos(la1) * F.sin(la2) - F.sin(la1) * F.cos(la2) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(x, y)) + F.lit(360.0), F.lit(360.0))
