"""Raw files to partitioned rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import (
    MINUTE_COLUMN_SINCE,
    START_FIELD_WITH_MINUTE,
    START_FIELD_WITHOUT_MINUTE,
    WIND_STEP_DEG,
)
from shoregrid.functions import grid, moments, text
from shoregrid.operators.spatial import clip_to_cells, nearest_grid


def file_year(filename: Column) -> Column:
    """Year at the end of a file name, before its `.txt`."""
    return text.tail_slice(text.part(filename, ".txt", 1), -4, -1).try_cast("int")


def first_measurement_field(filename: Column) -> Column:
    """Layout switch: files without a minute column start one field earlier."""
    return F.when(file_year(filename) < MINUTE_COLUMN_SINCE, START_FIELD_WITHOUT_MINUTE).otherwise(
        START_FIELD_WITH_MINUTE
    )


def buoy_bronze(lines: DataFrame, marker: str = "stdmet/", compat: bool = False) -> DataFrame:
    """Unparsed observation lines with station and time: (filename, line) in.

    Files before the layout change have no minute; `compat=True` takes their fifth field (the wind
    direction) for it all the same, as the old loader did.
    """
    line, name = F.col("line"), F.col("filename")
    f = [text.field_at(line, i) for i in range(1, 6)]
    minute = f[4]
    if not compat:
        minute = F.when(file_year(name) < MINUTE_COLUMN_SINCE, F.lit("0")).otherwise(minute)
    rows = lines.select(
        name,
        text.left(text.part(name, marker, 2), 5).alias("station_id"),
        moments.observation_time(*f[:4], minute).alias("timestamp_tz"),
        line,
    )
    year = F.date_trunc("YEAR", "timestamp_tz").alias("year")
    return rows.select("filename", "station_id", year, "timestamp_tz", "line")


def tide_bronze(rows: DataFrame) -> DataFrame:
    """Hourly gauge readings; station number and version end the file name."""
    name = F.col("filename")
    number, version = text.tail_slice(name, -8, -6), text.tail_slice(name, -5, -5)
    return rows.select(
        "filename",
        number.alias("uh_id"),
        version.alias("version"),
        F.concat(number, version).alias("station_id"),
        moments.observation_time(*[F.col(c) for c in ("year", "month", "day", "hour")]).alias(
            "timestamp_tz"
        ),
        F.col("reading_mm").cast("long").alias("reading_mm"),
    )


def wind_bronze(
    gridded: DataFrame,
    mask: DataFrame,
    lookup: DataFrame,
    component: str,
    step: float = WIND_STEP_DEG,
) -> DataFrame:
    """One wind component at the wanted lattice points.

    `gridded` has `hour` (yyyyMMddHH), `longitude` of any turn, `latitude` and `value`; `lookup`
    has the wanted points as `lon` and `lat`; `mask` the cells to keep.
    """
    placed = gridded.select(
        "hour",
        grid.normalise_lon(F.col("longitude")).alias("grid_lon"),
        F.col("latitude").alias("grid_lat"),
        F.col("value").cast("double").alias("wind_dim_val"),
    )
    inside = clip_to_cells(placed, mask, "grid_lon", "grid_lat")
    wanted = nearest_grid(lookup.select("lon", "lat"), inside, step)
    utc = moments.compact_hour(F.col("hour").cast("string"))
    return wanted.select(
        "wind_dim_val",
        F.lit(component).alias("wind_dim"),
        F.col("grid_lon").alias("longitude"),
        F.col("grid_lat").alias("latitude"),
        utc.alias("utc_date"),
        F.date_trunc("MONTH", utc).cast("timestamp_ntz").alias("utc_month"),
        "cell",
    )
