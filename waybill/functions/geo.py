"""Distances, regions and route measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Earth radius, region boundaries, rough km per degree, complexity scale.
EARTH_RADIUS_KM = 6371.0
NORTH_ABOVE = 40.75
SOUTH_BELOW = 40.65
EAST_WEST_LON = -73.85
KM_PER_DEGREE = 111.0
COMPLEXITY_KM = 10.0
COMPLEXITY_MAX = 10.0


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def no_nan(value: Column | str) -> Column:
    """NaN as null: Spark orders NaN above every number, the rules here mean 'unknown'."""
    value = col(value)
    return F.when(~F.isnan(value), value)


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres; null when a coordinate is null."""
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    chord = F.when(chord > 1.0, F.lit(1.0)).otherwise(chord)
    return F.asin(F.sqrt(chord)) * (2 * EARTH_RADIUS_KM)


def assign_region(lat, lon) -> Column:
    """Latitude band, with the side of the dividing longitude; unknown latitude is central."""
    lat, lon = no_nan(lat), no_nan(lon)
    band = (
        F.when(lat > NORTH_ABOVE, "North").when(lat < SOUTH_BELOW, "South").otherwise("Central")
    )
    side = F.when(lon > EAST_WEST_LON, "_East").when(lon < EAST_WEST_LON, "_West").otherwise("")
    return F.concat(band, side)


def degrees_apart(lat1, lon1, lat2, lon2) -> Column:
    """Straight-line distance in degrees."""
    d_lat, d_lon = col(lat2) - col(lat1), col(lon2) - col(lon1)
    return F.sqrt(d_lat * d_lat + d_lon * d_lon)


def route_complexity(lat1, lon1, lat2, lon2) -> Column:
    """Rough route length on a 0-10 scale; null stays null."""
    score = degrees_apart(lat1, lon1, lat2, lon2) * KM_PER_DEGREE / COMPLEXITY_KM
    return F.when(score > COMPLEXITY_MAX, F.lit(COMPLEXITY_MAX)).otherwise(score)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``haversine_km`` and ``assign_region`` callable from SQL (inlined by Catalyst)."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION haversine_km(
          lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE
        RETURN 2 * {EARTH_RADIUS_KM}D * asin(sqrt(
          pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
          + cos(radians(lat1)) * cos(radians(lat2))
            * pow(sin((radians(lon2) - radians(lon1)) / 2), 2)))
        """
    )
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION assign_region(lat DOUBLE, lon DOUBLE) RETURNS STRING
        RETURN concat(
          CASE WHEN isnan(lat) THEN 'Central' WHEN lat > {NORTH_ABOVE}D THEN 'North'
               WHEN lat < {SOUTH_BELOW}D THEN 'South' ELSE 'Central' END,
          CASE WHEN isnan(lon) THEN '' WHEN lon > {EAST_WEST_LON}D THEN '_East'
               WHEN lon < {EAST_WEST_LON}D THEN '_West' ELSE '' END)
        """
    )
