"""Wind speed and direction from vector components."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_from(u: Column, v: Column) -> Column:
    """Direction the wind blows from, in degrees clockwise from north, [0, 360)."""
    return F.pmod(F.degrees(F.atan2(-u, -v)) + 360.0, F.lit(360.0))
