"""Geographic column functions (JVM-side, codegen; no UDF)."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
EARTH_RADIUS_KM = 6371.0
KM_TO_MILES = 0.621371


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km between two (lat, lon) points given in degrees.

    a = sin²(Δφ/2) + cos φ1 · cos φ2 · sin²(Δλ/2);  d = 2R · atan2(√a, √(1−a)).
    Null when any coordinate is null.
    """
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2))
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def km_to_miles(km) -> Column:
    return _c(km) * F.lit(KM_TO_MILES)
