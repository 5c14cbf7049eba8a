"""One feature vector per cell and hour, and search over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import MATCH_WINDOW_MINUTES
from shoregrid.functions.grid import cell_of
from shoregrid.functions.media import photo_time, signed_degrees
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators.sized import join_dimension, settled
from shoregrid.operators.search import make_vector, search_by_media
from shoregrid.operators.vector_index import VectorIndex, photo_search
from shoregrid.plans.silver import between

FEATURES = [
    "idw_wave_height",
    "idw_average_wave_period",
    "idw_measured_wave_direction",
    "tide_meters",
    "wind_speed",
    "wind_direction",
]


def merged_conditions(
    buoys: DataFrame,
    wind: DataFrame,
    tides: DataFrame,
    start=None,
    end=None,
    ts: str = "timestamp_tz",
) -> DataFrame:
    """Buoy rows with gridded wind and gauge tide where present, else the buoy's own.

    Gauge tide is in millimetres and turned to metres; the buoy's tide is taken as it is. Wind and
    tide are first cut to cells that have buoy rows at all.
    """
    base = between(buoys, start, end, ts)
    active = settled(base.select("cell").distinct(), "active-cells")
    keep = lambda df: join_dimension(between(df, start, end, ts), active, ["cell"], "left_semi")
    speeds = keep(wind.select("cell", ts, "wind_speed_ms", "wind_dir"))
    levels = keep(tides.select("cell", ts, "idw_mm"))
    return (
        base.join(levels, ["cell", ts], "left")
        .join(speeds, ["cell", ts], "left")
        .select(
            "cell",
            ts,
            "idw_wave_height",
            "idw_average_wave_period",
            "idw_measured_wave_direction",
            F.coalesce(round_half_away(F.col("idw_mm") / 1000.0, 2), "idw_tide").alias(
                "tide_meters"
            ),
            F.coalesce("wind_speed_ms", "idw_wind_speed").alias("wind_speed"),
            F.coalesce("wind_dir", "idw_wind_direction").alias("wind_direction"),
        )
    )


def condition_tags(
    buoys: DataFrame,
    wind: DataFrame,
    tides: DataFrame,
    start=None,
    end=None,
    ts: str = "timestamp_tz",
) -> DataFrame:
    """(time, cell, seven-element vector) for every hour whose features are all known.

    The vector holds the cell and the six features in the order of `FEATURES`. A cell id as a
    double may lose its low bits, so join on the `cell` column.
    """
    complete = merged_conditions(buoys, wind, tides, start, end, ts).dropna(subset=FEATURES)
    features = [F.col(c) for c in FEATURES[:4]] + [
        round_half_away(F.col(c).cast("double"), 2) for c in FEATURES[4:]
    ]
    return complete.select(ts, "cell", make_vector(F.col("cell"), *features).alias("tag"))


def photos(tags: DataFrame) -> DataFrame:
    """Photo tag rows to (photo, lon, lat, taken): magnitudes with hemisphere letters, local time."""
    return tags.select(
        "photo",
        signed_degrees(F.col("gps_longitude"), F.col("gps_longitude_ref")).alias("lon"),
        signed_degrees(F.col("gps_latitude"), F.col("gps_latitude_ref")).alias("lat"),
        photo_time(F.col("date_time"), F.col("offset_time")).alias("taken"),
    )


def similar_hours(photo_tags: DataFrame, tags: DataFrame, ts: str = "timestamp_tz") -> DataFrame:
    """For each photo the hours with similar conditions."""
    return search_by_media(photos(photo_tags), tags, "photo", "taken", ts, "tag")


def photo_conditions(photo_tags: DataFrame, index: VectorIndex, ts: str = "timestamp_tz") -> tuple[DataFrame, DataFrame]:
    """From a stored index of tags: the hour of each photo, and the hours like each such hour."""
    taken = photos(photo_tags).select("photo", cell_of(F.col("lon"), F.col("lat")).alias("cell"), "taken")
    return photo_search(index, taken, "photo", "taken", ts, MATCH_WINDOW_MINUTES)
