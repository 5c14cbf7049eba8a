"""Half-degree lattice cells, distances and tile keys as column expressions.

A cell id is ``row * 720 + column``; the step of 0.5 degrees is a power of two, so ids and
centres are exact. Tables that carry other cell ids work as well: the operators take the cell
column, and a neighbour table, as input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoregrid.fixed_values import EARTH_RADIUS_M

PER_DEGREE = 2
COLUMNS = 360 * PER_DEGREE
ROWS = 180 * PER_DEGREE
TILE = 16


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def point_from_text(text: Column) -> Column:
    """``POINT (lon lat)`` text to a point struct; NULL when the text is something else."""
    pattern = r"(?i)^\s*POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)\s*$"
    return F.when(
        text.rlike(pattern),
        point(
            F.regexp_extract(text, pattern, 1).try_cast("double"),
            F.regexp_extract(text, pattern, 2).try_cast("double"),
        ),
    )


def point_to_text(p: Column) -> Column:
    return F.concat(
        F.lit("POINT ("), p["lon"].cast("string"), F.lit(" "), p["lat"].cast("string"), F.lit(")")
    )


def normalise_lon(lon: Column) -> Column:
    """Longitude of any turn to [-180, 180)."""
    return F.pmod(lon + F.lit(180.0), F.lit(360.0)) - F.lit(180.0)


def cell_of(lon: Column, lat: Column) -> Column:
    col = F.pmod(F.floor((lon + 180.0) * PER_DEGREE), F.lit(COLUMNS))
    # `least` and `greatest` skip NULLs: unknown places must stay unknown.
    row = F.when(lat.isNotNull(), F.least(F.floor((lat + 90.0) * PER_DEGREE), F.lit(ROWS - 1)))
    return (row * COLUMNS + col).cast("long")


def cell_row(cell: Column) -> Column:
    return F.floor(cell / F.lit(float(COLUMNS))).cast("long")


def cell_col(cell: Column) -> Column:
    return F.pmod(cell, F.lit(COLUMNS)).cast("long")


def tile(cell: Column) -> Column:
    """Number of the square of TILE by TILE cells that a cell lies in."""
    across = COLUMNS // TILE
    return F.floor(cell_row(cell) / F.lit(float(TILE))) * across + F.floor(cell_col(cell) / F.lit(float(TILE)))


def centre_lon(cell: Column) -> Column:
    return (cell_col(cell) + 0.5) / PER_DEGREE - 180.0


def centre_lat(cell: Column) -> Column:
    return (cell_row(cell) + 0.5) / PER_DEGREE - 90.0


def cell_centre(cell: Column) -> Column:
    return point(centre_lon(cell), centre_lat(cell))


def disk(cell: Column, rings: int) -> Column:
    """Ids of all cells at most ``rings`` steps away, itself included; wraps at the dateline."""
    span = F.sequence(F.lit(-rings), F.lit(rings))
    ids = F.flatten(
        F.transform(
            span,
            lambda dy: F.transform(
                span,
                lambda dx: F.when(
                    (cell_row(cell) + dy).between(0, ROWS - 1),
                    (cell_row(cell) + dy) * COLUMNS
                    + F.pmod(cell_col(cell) + dx, F.lit(COLUMNS)),
                ).cast("long"),
            ),
        )
    )
    return F.array_compact(ids)


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres; exactly 0 for equal points."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(dlon / 2), F.lit(2.0))
    half_angle = F.when(h.isNotNull(), F.asin(F.least(F.sqrt(h), F.lit(1.0))))
    return F.lit(2 * EARTH_RADIUS_M) * half_angle


def segment_distance_sq(
    px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column
) -> Column:
    """Squared planar distance from a point to a segment."""
    dx, dy = bx - ax, by - ay
    along = F.coalesce(
        F.try_divide((px - ax) * dx + (py - ay) * dy, dx * dx + dy * dy), F.lit(0.0)
    )
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (ax + t * dx), py - (ay + t * dy)
    return ex * ex + ey * ey


def snap(value: Column, step: float, origin: float = 0.0) -> Column:
    """Nearest coordinate of a regular axis."""
    return F.floor((value - origin) / step + 0.5) * F.lit(step) + origin


def within_box(
    lon: Column, lat: Column, west: float, south: float, east: float, north: float
) -> Column:
    return (lon >= west) & (lon <= east) & (lat >= south) & (lat <= north)


def quadkey(lon: Column, lat: Column, zoom: int) -> Column:
    """Web-Mercator tile key: one base-4 digit per zoom level."""
    tiles = 1 << zoom
    s = F.sin(F.radians(lat))
    fx = (lon + 180.0) / 360.0
    fy = F.lit(0.5) - F.log((1.0 + s) / (1.0 - s)) / (4 * math.pi)

    def tile(fraction: Column) -> Column:
        inside = F.least(F.greatest(F.floor(fraction * tiles), F.lit(0)), F.lit(tiles - 1))
        return F.when(fraction.isNotNull(), inside)

    def bit(number: Column, level: int) -> Column:
        return F.shiftright(number, level).bitwiseAND(F.lit(1))

    x, y = tile(fx), tile(fy)
    digits = [
        (bit(x, level) + bit(y, level) * 2).cast("string") for level in range(zoom - 1, -1, -1)
    ]
    return F.concat(*digits)
