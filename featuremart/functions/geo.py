"""Distance on the sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres.
EARTH_RADIUS_M = 6_371_000.0


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres, null when a coordinate is missing.

    Rounding can push the cosine of a tiny angle outside [-1, 1], where acos
    gives NaN, so it is clamped. Equal points are 0 by comparison: there the
    cosine may also land just below 1, which acos turns into a few centimetres.
    """
    lon1, lat1, lon2, lat2 = (F.radians(c) for c in (lon1, lat1, lon2, lat2))
    cosine = F.sin(lat1) * F.sin(lat2) + F.cos(lat1) * F.cos(lat2) * F.cos(lon1 - lon2)
    # least and greatest skip nulls, so the missing case has to be kept apart
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    same = (lon1 == lon2) & (lat1 == lat2)
    return F.when(same, F.lit(0.0)).when(cosine.isNotNull(), F.acos(clamped) * EARTH_RADIUS_M)
