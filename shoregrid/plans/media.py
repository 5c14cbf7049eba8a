"""Clips with their place and time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import SPOTS
from shoregrid.functions import media


def place_clips(clips: DataFrame, name: str) -> DataFrame:
    """Add spot, UTC time, latitude and longitude to clips by their file name."""
    known = F.create_map(
        *[x for spot, lat, lon in SPOTS
          for x in (F.lit(spot), F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon")))]
    )
    return (
        clips.withColumn("spot", media.clip_spot(F.col(name)))
        .withColumn("taken", media.clip_time(F.col(name)))
        .withColumn("_place", F.try_element_at(known, F.col("spot")))
        .select("*", "_place.lat", "_place.lon")
        .drop("_place")
    )
