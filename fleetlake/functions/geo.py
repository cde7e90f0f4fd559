"""Distances on the sphere and the coarse region of a point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km; bounds of the central region in degrees.
EARTH_RADIUS_KM = 6371.009
CENTRE_LAT = (-23.57, -23.55)
CENTRE_LON = (-46.65, -46.55)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; NULL if any coordinate is NULL."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = F.pow(half_lat, F.lit(2.0)) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(half_lon, F.lit(2.0))
    )
    # Rounding can lift the root above 1 for antipodal points; least() skips NULL,
    # so the bound must not turn a missing coordinate into a distance.
    root = F.sqrt(chord)
    return F.when(
        root.isNotNull(), F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.least(F.lit(1.0), root))
    )


def region_of(lat: Column, lon: Column) -> Column:
    """Centre if inside the central box, else East or West of its western edge."""
    inside_lat = (lat > F.lit(CENTRE_LAT[0])) & (lat < F.lit(CENTRE_LAT[1]))
    inside_lon = (lon > F.lit(CENTRE_LON[0])) & (lon < F.lit(CENTRE_LON[1]))
    return (
        F.when(inside_lat & inside_lon, F.lit("Centre"))
        .when(lon > F.lit(CENTRE_LON[0]), F.lit("East"))
        .otherwise(F.lit("West"))
    )
