"""Distances on the sphere and grid cells that bound them."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0
METRES_PER_MILE = 1609.344
METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; NULL when any coordinate is NULL."""
    half_lat = F.sin(F.radians(lat2 - lat1) * 0.5)
    half_lon = F.sin(F.radians(lon2 - lon1) * 0.5)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.when(chord > 1, F.lit(1.0)).otherwise(chord)))


def shortest_m(lat_apart: Column, lon_apart: Column, parallel: Column) -> Column:
    """A distance no two points so many degrees apart fall short of.

    Parallel is the cosine of the outermost latitude. This is the straight line through the sphere.
    """
    half_lat, half_lon = F.sin(F.radians(lat_apart) * 0.5), F.sin(F.radians(lon_apart) * 0.5) * parallel
    return F.sqrt(half_lat * half_lat + half_lon * half_lon) * (2 * EARTH_RADIUS_M)


def longest_m(lat_apart: Column, lon_apart: Column, parallel: Column) -> Column:
    """A distance no two points at most so many degrees apart exceed.

    Parallel is the cosine of the innermost latitude. Angles stand in for their sines.
    """
    half_lat, half_lon = F.radians(lat_apart) * 0.5, F.radians(lon_apart) * 0.5 * parallel
    chord = F.sqrt(half_lat * half_lat + half_lon * half_lon)
    return F.asin(F.least(chord, F.lit(1.0))) * (2 * EARTH_RADIUS_M)


# Cells. A grid of size s has latitude rows s metres high. Each row is cut into a whole number of
# longitude cells, wide enough that two points at most s metres apart, in this row or a row next to
# it, never lie more than one cell apart. So all points within s metres of a point are found in its
# own cell when every point is also listed in the eight cells around it. The count of cells per row
# depends on latitude only: it needs no pass over the data, wraps at 180 degrees, and drops to one
# cell near the poles. Halving the cells both ways n times gives the finer grid of level n.


# A step is the height of a row in degrees. Places with unknown coordinates get cell -1: with keys
# that are never NULL, Spark has no NULL test to push below the expressions that compute them.


def whole(position: Column) -> Column:
    return F.coalesce(F.floor(position), F.lit(-1))


def row_position(lat: Column, step: float) -> Column:
    """Rows from the south pole, with the fraction inside the row."""
    return (lat + 90.0) * (1 / step)


def column_position(lon: Column, cells: Column) -> Column:
    """Cells from the date line, with the fraction inside the cell."""
    return F.least(lon_share(lon) * cells, cells * (1 - 1e-15))


def cells_in_row(row: Column, step: float) -> Column:
    """Number of cells in a row, from the parallel that bounds the rows next to it.

    On that parallel s metres span at most 1.01 times s over its radius, as long as s is small
    against the radius; where it is not, the row is one cell.
    """
    middle = F.abs((row + 0.5) * step - 90.0)
    parallel = F.cos(F.radians(F.least(middle + 1.5 * step, F.lit(90.0))))
    cells = F.floor(parallel * (360 / 1.01 / step))
    return F.when(parallel >= 2.5 * math.radians(step), cells).otherwise(F.lit(1).cast("bigint"))


def lon_share(lon: Column) -> Column:
    """Longitude as a share of the way round from the date line, whatever turn it is given in."""
    return F.pmod((lon + 180.0) * (1 / 360), F.lit(1.0))


def degrees_apart(lon1: Column, lon2: Column) -> Column:
    """Difference of longitudes the short way round."""
    return F.abs(F.pmod(lon1 - lon2 + 180.0, F.lit(360.0)) - 180.0)
