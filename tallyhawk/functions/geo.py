"""Distances on the globe as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres; null when a coordinate is null."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    # Rounding can push the chord of two antipodes just past 1. A null chord must
    # stay null, and least() would skip it.
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(
        F.when(chord > 1.0, F.lit(1.0)).otherwise(F.sqrt(chord))
    )


def safe_haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance that is 0 for coordinates that are missing or not numbers."""
    numbers = [c.try_cast("double") for c in (lat1, lon1, lat2, lon2)]
    return F.coalesce(F.nanvl(haversine_km(*numbers), F.lit(0.0)), F.lit(0.0))


def add_home_distance(df: DataFrame) -> DataFrame:
    """Distance between the cardholder's home and the merchant."""
    return df.withColumn(
        "customer_merchant_distance_km",
        haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")),
    )
