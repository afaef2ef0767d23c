"""Great-circle distance and unit vectors as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value
HALF_CIRCUMFERENCE_KM = math.pi * EARTH_RADIUS_KM


def valid_coords(lat: Column, lon: Column) -> Column:
    """Inclusive range test; NULL and NaN do not pass a filter on it."""
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance; NULL if any input is NULL."""
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_lon), F.lit(2))
    # Rounding can push a past 1 at antipodes. least() would turn NULL into 1.
    a = F.when(a.between(1.0, 2.0), 1.0).otherwise(a)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(a))


def slc_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines, with the cosine held to [-1, 1]."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    c = F.cos(phi1) * F.cos(phi2) * F.cos(F.radians(lon2) - F.radians(lon1)) + F.sin(
        phi1
    ) * F.sin(phi2)
    c = F.when(c.between(1.0, 2.0), 1.0).when(c.between(-2.0, -1.0), -1.0).otherwise(c)
    return EARTH_RADIUS_KM * F.acos(c)


DISTANCES = {"haversine": haversine_km, "slc": slc_km}


def with_unit_vector(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    """Adds the point's unit vector as three columns named by ``prefix``."""
    phi, lam = f"radians({lat})", f"radians({lon})"
    return df.selectExpr(
        "*",
        f"cos({phi}) * cos({lam}) AS {prefix}x",
        f"cos({phi}) * sin({lam}) AS {prefix}y",
        f"sin({phi}) AS {prefix}z",
    )


def dot(p: str, q: str) -> str:
    """SQL for the dot product of two vectors named by prefix."""
    return " + ".join(f"{p}{a} * {q}{a}" for a in "xyz")


def chord_squared(p: str, q: str) -> str:
    """SQL for the squared straight-line distance of two unit vectors: no trigonometry."""
    return " + ".join(f"({p}{a} - {q}{a}) * ({p}{a} - {q}{a})" for a in "xyz")
