"""Tile names and grid arithmetic as column expressions. A tile is a 10-degree square named by its north-west corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terraflux.factors import EQUATOR_M, MERIDIAN_M

SPAN = 10
#: Column of a stored pixel table: latitude of the tile's northern edge.
LAT = "tile_lat"
# What names look like for each partitioning.
PATTERNS = {
    "ONE_DEGREE": r"^[0-9]{2}[NS]_[0-9]{3}[EW]$",
    "TEN_DEGREE": r"^[0-9]0[NS]_[0-9]{2}0[EW]$",
    "WHOLE_WORLD": r"^world$",
    "XYZ_MERCATOR": r"^[0-9]{3}X_[0-9]{3}Y_[0-9]{2}Z$",
}


def lat_of(tile: Column) -> Column:
    n = F.substring(tile, 1, 2).cast("int")
    return F.when(F.substring(tile, 3, 1) == "N", n).otherwise(-n)


def lon_of(tile: Column) -> Column:
    n = F.substring(tile, 5, 3).cast("int")
    return F.when(F.substring(tile, 8, 1) == "E", n).otherwise(-n)


def tile_of(lat: Column, lon: Column) -> Column:
    """Name of the tile at a corner; 0 is north and east."""
    ns, ew = F.when(lat >= 0, "N").otherwise("S"), F.when(lon >= 0, "E").otherwise("W")
    return F.concat(F.lpad(F.abs(lat).cast("string"), 2, "0"), ns, F.lit("_"), F.lpad(F.abs(lon).cast("string"), 3, "0"), ew)


def is_valid(tile: Column, partitioning: str) -> Column:
    return tile.rlike(PATTERNS[partitioning])


def row_lat(top: Column, row: Column, n: int) -> Column:
    """Latitude of the centres of a tile's pixel row, from the tile's northern edge."""
    return top - (row + 0.5) * (SPAN / n)


def pixel_lat(tile: Column, row: Column, n: int) -> Column:
    """Latitude of a pixel's centre, ``n`` pixels a tile side."""
    return row_lat(lat_of(tile), row, n)


def pixel_lon(tile: Column, col: Column, n: int) -> Column:
    return lon_of(tile) + (col + 0.5) * (SPAN / n)


def hectares(lat: Column, degrees: float) -> Column:
    """Area of a pixel of ``degrees`` a side at a latitude."""
    at_equator = (degrees * (MERIDIAN_M / 360)) * (degrees * (EQUATOR_M / 360)) / 10_000
    return F.cos(F.radians(lat)) * F.lit(at_equator)
