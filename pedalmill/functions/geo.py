"""Distances, boxes and grid cells on latitude/longitude columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
#: Metres per degree in the flat approximation, and the latitude its longitudes use.
FLAT_M_PER_DEGREE = 111_139.0
FLAT_LATITUDE = 40.7

# Bounding boxes (lat_min, lat_max, lon_min, lon_max) per system.
SYSTEM_BOXES = {
    "nyc": (40.4, 41.0, -74.3, -73.7),
    "jc": (40.68, 40.78, -74.12, -74.01),
}


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    h = (F.sin(half_dlat) * F.sin(half_dlat)
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(half_dlon) * F.sin(half_dlon))
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def flat_distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                    at_latitude: float = FLAT_LATITUDE) -> Column:
    """Planar distance, good to well under 1 % inside one city."""
    dy = (lat1 - lat2) * FLAT_M_PER_DEGREE
    dx = (lon1 - lon2) * FLAT_M_PER_DEGREE * F.cos(F.radians(F.lit(at_latitude)))
    return F.sqrt(dy * dy + dx * dx)


def in_box(lat: Column, lon: Column, box: Sequence[float] | str) -> Column:
    lat_min, lat_max, lon_min, lon_max = SYSTEM_BOXES[box] if isinstance(box, str) else box
    return lat.between(lat_min, lat_max) & lon.between(lon_min, lon_max)


def crosses_west_to_east(start_lon: Column, end_lon: Column, boundary: float) -> Column:
    """Starts west and ends east of a meridian (both strictly)."""
    return (start_lon < boundary) & (end_lon > boundary)


def crosses_east_to_west(start_lon: Column, end_lon: Column, end_lat: Column, boundary: float,
                         lat_range: tuple[float, float] = (40.68, 40.78)) -> Column:
    return (start_lon > boundary) & (end_lon < boundary) & end_lat.between(*lat_range)


def zone_of(lat: Column, lon: Column, rules: Sequence[tuple], default: str) -> Column:
    """First matching rule wins; a rule is ``(min_lat, min_lon, max_lon, label)``.

    All bounds are strict and None leaves one open.
    """
    out = F.lit(default)
    for min_lat, min_lon, max_lon, label in reversed(list(rules)):
        cond = F.lit(True)
        if min_lat is not None:
            cond = cond & (lat > min_lat)
        if min_lon is not None:
            cond = cond & (lon > min_lon)
        if max_lon is not None:
            cond = cond & (lon < max_lon)
        out = F.when(cond, label).otherwise(out)
    return out


# Neighbourhood zones as (min_lat, min_lon, max_lon, label).
CITY_ZONES = [
    (40.78, None, None, "Upper Manhattan (>96th)"),
    (40.75, None, None, "Midtown/UES/UWS"),
    (40.72, None, None, "Chelsea/Gramercy/Murray Hill"),
    (40.70, -74.01, None, "East Village/LES"),
    (40.70, None, None, "West Village/SoHo/Tribeca"),
    (None, None, -73.98, "Brooklyn (Williamsburg area)"),
]


def cell(x: Column, size: Column | float) -> Column:
    """Index of the grid cell holding ``x``."""
    return F.floor(x / size).cast("long")


def cells_covering(lo: Column, hi: Column, size: Column | float) -> Column:
    """Array of all cell indexes from ``lo`` to ``hi``."""
    return F.sequence(cell(lo, size), cell(hi, size))


def lon_reach_deg(lat: Column, radius_deg: Column) -> Column:
    """Half-width in longitude of a spherical cap of ``radius_deg`` around ``lat``.

    Capped at 180 where the cap contains a pole.
    """
    s = F.sin(F.radians(radius_deg)) / F.cos(F.radians(lat))
    polar = (F.abs(lat) + radius_deg) >= 90
    return F.when(polar | (s >= 1), F.lit(180.0)).otherwise(F.degrees(F.asin(s)))
