"""Place and time of photos and clips from their names and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoregrid.fixed_values import SPOT_ZONE


def _name_part(name: Column, n: int) -> Column:
    bare = name
    for noise in (".mp4", ".MOV", "(1)"):
        bare = F.replace(bare, F.lit(noise), F.lit(""))
    return F.split_part(bare, F.lit("_"), F.lit(n))


def clip_spot(name: Column) -> Column:
    """Spot in ``prefix_spot_YYYYMMDD_HHMM.ext``."""
    return _name_part(name, 2)


def clip_time(name: Column, zone: str = SPOT_ZONE) -> Column:
    """UTC time of a clip whose name holds the local time of `zone`."""
    local = F.try_to_timestamp(
        F.concat(_name_part(name, 3), F.lit("_"), _name_part(name, 4)), F.lit("yyyyMMdd_HHmm")
    )
    return F.to_utc_timestamp(local, zone)


def to_dms(degrees: Column) -> Column:
    """Absolute value as whole degrees, minutes and seconds, each cut off."""
    whole = F.floor(F.abs(degrees))
    minutes = (F.abs(degrees) - whole) * 60.0
    seconds = (minutes - F.floor(minutes)) * 60.0
    return F.struct(
        whole.cast("int").alias("degrees"),
        F.floor(minutes).cast("int").alias("minutes"),
        F.floor(seconds).cast("int").alias("seconds"),
    )


def from_dms(dms: Column) -> Column:
    return dms["degrees"] + dms["minutes"] / 60.0 + dms["seconds"] / 3600.0


def hemisphere(degrees: Column, positive: str, negative: str) -> Column:
    return F.when(degrees >= 0, F.lit(positive)).otherwise(F.lit(negative))


def signed_degrees(magnitude: Column, ref: Column) -> Column:
    """Tag magnitude with its hemisphere letter (N, S, E, W) to signed degrees."""
    return F.when(F.substring(ref, 1, 1).isin("S", "W"), -magnitude).otherwise(magnitude)


def photo_time(stamp: Column, offset: Column) -> Column:
    """``YYYY:MM:DD HH:MM:SS`` and an offset like ``-10:00`` to a UTC instant."""
    return F.try_to_timestamp(F.concat(stamp, offset), F.lit("yyyy:MM:dd HH:mm:ssXXX"))
