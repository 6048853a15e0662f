"""Great-circle distance."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    # Rounding can push antipodal points a hair above 1, where asin is NaN. An unknown coordinate
    # must stay null, so this is not `least`, which skips nulls.
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.when(a > 1.0, 1.0).otherwise(a)))
