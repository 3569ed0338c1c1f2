"""Scalar distance for brute-force comparisons."""

import math

from stockmap.functions.geo import EARTH_RADIUS_KM


def haversine_km_py(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    """Scalar twin of :func:`haversine_km` for tests and bounds."""
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin(math.radians(lat2 - lat1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * EARTH_RADIUS_KM * math.atan2(math.sqrt(a), math.sqrt(1 - a))
