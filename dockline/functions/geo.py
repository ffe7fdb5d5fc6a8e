"""Great-circle distance as a native Column expression."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import settings as S


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km (R = 6371). Arguments: column names,
    Columns or numbers."""
    la1, lo1, la2, lo2 = map(_c, (lat1, lon1, lat2, lon2))
    dphi = F.radians(la2 - la1)
    dlmb = F.radians(lo2 - lo1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * S.EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))
