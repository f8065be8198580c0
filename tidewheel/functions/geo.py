"""Distances and directions as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE_NORTH = 111.0
KM_PER_DEGREE_EAST = 84.0
STREET_GRID_DEGREES = 29.0
ZONE_LATITUDE = 40.73
LAT_RANGE = (40.4, 41.1)
LNG_RANGE = (-74.4, -73.5)


def haversine_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance; the root argument is clipped to [0, 1]."""
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lng = F.sin((F.radians(lng2) - F.radians(lng1)) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lng * half_lng
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), h))))


def offsets_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> tuple[Column, Column]:
    """(north, east) displacement in planar kilometres."""
    return (lat2 - lat1) * KM_PER_DEGREE_NORTH, (lng2 - lng1) * KM_PER_DEGREE_EAST


def grid_distance_km(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance along street axes that are turned away from north."""
    north, east = offsets_km(lat1, lng1, lat2, lng2)
    turn = F.radians(F.lit(STREET_GRID_DEGREES))
    return F.abs(east * F.cos(turn) + north * F.sin(turn)) + F.abs(north * F.cos(turn) - east * F.sin(turn))


def bearing_parts(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> tuple[Column, Column]:
    """Sine and cosine of the compass bearing."""
    north, east = offsets_km(lat1, lng1, lat2, lng2)
    angle = F.atan2(east, north)
    return F.sin(angle), F.cos(angle)


def planar_km(lat: Column, lng: Column) -> tuple[Column, Column]:
    """Coordinates in kilometres on the city's own latitude."""
    scale = F.cos(F.radians(F.lit(ZONE_LATITUDE)))
    return lat * KM_PER_DEGREE_NORTH, lng * (KM_PER_DEGREE_NORTH * scale)


def in_box(lat: Column, lng: Column) -> Column:
    """Inclusive service-area box; null coordinates are outside."""
    inside = lat.between(*LAT_RANGE) & lng.between(*LNG_RANGE)
    return F.coalesce(inside, F.lit(False))


def in_world(lat: Column, lng: Column) -> Column:
    return F.coalesce(lat.between(-90, 90) & lng.between(-180, 180), F.lit(False))


def location_key(lat: Column, lng: Column) -> Column:
    """Same place on about ten metres: coordinates in ten-thousandths of a degree."""
    return F.concat_ws(",", F.round(lat * 10000).cast("long"), F.round(lng * 10000).cast("long"))
