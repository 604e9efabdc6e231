"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: mean radius of the earth in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees; null if any coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # rounding can push antipodal points past 1, where asin is undefined
    bounded = F.when(chord > 1.0, 1.0).otherwise(chord)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(bounded))


def with_distance(
    df: DataFrame, lat: str, lon: str, other_lat: str, other_lon: str, out: str = "distance_km"
) -> DataFrame:
    """Add the distance column unless the table already has it."""
    if out in df.columns:
        return df
    points = [F.col(name) for name in (lat, lon, other_lat, other_lon)]
    return df.withColumn(out, haversine_km(*points))
