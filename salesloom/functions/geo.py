"""Coordinates per region."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Map pins (latitude, longitude) of the four sales regions.
REGION_COORDS = {
    "North": (28.6, 77.2),
    "South": (12.9, 77.6),
    "East": (22.5, 88.3),
    "West": (19.0, 72.8),
}


def lookup(key: Column, table: dict[str, float]) -> Column:
    """Constant-map lookup; NULL for unknown keys."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def latitude(region: Column, coords: dict[str, tuple[float, float]] = REGION_COORDS) -> Column:
    return lookup(region, {name: lat for name, (lat, _) in coords.items()})


def longitude(region: Column, coords: dict[str, tuple[float, float]] = REGION_COORDS) -> Column:
    return lookup(region, {name: lon for name, (_, lon) in coords.items()})
