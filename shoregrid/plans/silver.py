"""Conformed measurements and their interpolation onto coastal cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import (
    MISSING_DIRECTION,
    MISSING_SPEED,
    MISSING_TIDE,
    MISSING_WAVE,
    OBSERVATION_FILLS,
    TIDE_FLOOR_MM,
)
from shoregrid.functions import grid, numbers
from shoregrid.functions.wind import wind_from, wind_speed
from shoregrid.operators.interpolate import hourly_mean, idw
from shoregrid.operators.joins import scd_join
from shoregrid.operators.sized import join_dimension
from shoregrid.operators.spatial import disk_join
from shoregrid.plans.bronze import first_measurement_field

DEFAULT_TS = "timestamp_tz"


def between(df: DataFrame, start, end, ts: str = DEFAULT_TS) -> DataFrame:
    """Both ends included; None leaves a side open."""
    if start is not None:
        df = df.where(F.col(ts) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(ts) <= F.lit(end))
    return df


def measured_numbers(line: Column, first: Column) -> Column:
    """The thirteen numbers of a line from field `first` on; NULL where unreadable or missing.

    Each token is parsed once, in one array expression: thirteen separate ones would make the
    generated method too long for the JIT compiler.
    """
    return F.transform(F.slice(line, first, len(OBSERVATION_FILLS)), numbers.parse_double)


def measurement_columns(values: Column, compat: bool = False) -> list[Column]:
    """The measurements by name, unreadable ones replaced by the fill of their column."""
    out = []
    for position, (name, kind, fill) in enumerate(OBSERVATION_FILLS):
        number = F.get(values, position)
        if kind == "int":
            value = F.coalesce(numbers.to_int_half_away(number), F.lit(int(fill)))
        elif kind == "rounded_int":
            default = fill if compat else float(MISSING_DIRECTION)
            value = numbers.to_int_half_even(F.coalesce(number, F.lit(default)))
        else:
            value = F.coalesce(number, F.lit(fill))
        out.append(value.alias(name))
    return out


def buoy_measurements(
    bronze: DataFrame, history: DataFrame, start=None, end=None, compat: bool = False
) -> DataFrame:
    """Parsed buoy observations with the station record that held at their time.

    An unreadable wave direction becomes the missing marker 999; `compat=True` keeps the former
    1000 (999.9 rounded), which later steps do not recognise as missing.
    """
    raw = between(bronze, start, end).select(
        "station_id",
        "timestamp_tz",
        measured_numbers(F.col("line"), first_measurement_field(F.col("filename"))).alias(
            "_values"
        ),
    )
    known = history.select("station_id", "station_sk", "geometry", "cell", "start_time", "end_time")
    placed = scd_join(raw, known, "station_id", "timestamp_tz")
    return placed.select(
        "station_id",
        "timestamp_tz",
        "station_sk",
        "geometry",
        "cell",
        *measurement_columns(F.col("_values"), compat),
    )


def tide_measurements(bronze: DataFrame, stations: DataFrame, start=None, end=None) -> DataFrame:
    rows = between(bronze, start, end).select("station_id", "timestamp_tz", "reading_mm")
    return join_dimension(rows, stations.select("station_id", "geometry", "cell"), ["station_id"])


def wind_measurements(bronze: DataFrame, start=None, end=None) -> DataFrame:
    """Speed and direction per cell and hour from the averaged components.

    Averages equal those of all component pairs of the cell, without forming the pairs. The
    geometry is that of the point with the greatest (longitude, latitude) in the cell.
    """
    v = F.avg(F.when(F.col("wind_dim") == "VAR_10V", F.col("wind_dim_val"))).alias("v")
    u = F.avg(F.when(F.col("wind_dim") == "VAR_10U", F.col("wind_dim_val"))).alias("u")
    place = F.when(F.col("wind_dim") == "VAR_10U", F.struct("longitude", "latitude"))
    both = (
        between(bronze, start, end, "utc_date")
        .groupBy("cell", F.col("utc_date").alias("timestamp_tz"))
        .agg(u, v, F.max(place).alias("_place"))
        .where("u is not null and v is not null")
    )
    return both.select(
        "cell",
        grid.point(F.col("_place.longitude"), F.col("_place.latitude")).alias("geometry"),
        wind_speed(F.col("u"), F.col("v")).alias("wind_speed_ms"),
        wind_from(F.col("u"), F.col("v")).alias("wind_dir"),
        "timestamp_tz",
    )


def stations_of(df: DataFrame, station: str = "station_id") -> DataFrame:
    """Station dimension in the shape the disk join takes, from (station, geometry, cell)."""
    return df.select(
        station,
        F.col("cell").alias("station_cell"),
        F.col("geometry.lon").alias("lon"),
        F.col("geometry.lat").alias("lat"),
    )


def tide_idw(
    cells: DataFrame,
    stations: DataFrame,
    measurements: DataFrame,
    start=None,
    end=None,
    digits: int = 2,
) -> DataFrame:
    """Tide per cell and hour from the gauges around it, implausible readings left out."""
    near = disk_join(cells, stations_of(stations), "station_id")
    kept = between(measurements, start, end).where(F.col("reading_mm") >= TIDE_FLOOR_MM)
    result = idw(near, kept, "station_id", "timestamp_tz", ["reading_mm"], digits)
    return result.withColumnRenamed("idw_reading_mm", "idw_mm")


BUOY_CHANNELS = {
    "wave_height": (MISSING_WAVE,),
    "average_wave_period": (MISSING_WAVE,),
    "measured_wave_direction": (MISSING_DIRECTION,),
    "wind_direction": (MISSING_DIRECTION,),
    "wind_speed": (MISSING_SPEED, 999.9),
    "tide": (MISSING_TIDE,),
}


def buoy_idw(
    cells: DataFrame,
    measurements: DataFrame,
    start=None,
    end=None,
    digits: int = 2,
    compat: bool = False,
    circular: bool = False,
) -> DataFrame:
    """Wave, wind and tide channels per cell and hour from the buoys around it.

    A reading counts where its station stood when it was taken (its station record). `compat=True`
    lets readings count at every place that their station had in the range, counts weights of
    missing readings and takes the unreadable wind speed 999.9 for a value, as the old model did. `circular=True` averages directions on the compass within
    the hour.
    """
    chosen = between(measurements, start, end)
    station = "station_id" if compat else "_record"
    if not compat:
        chosen = chosen.withColumn(station, F.concat_ws("|", "station_id", "station_sk"))
    near = disk_join(cells, stations_of(chosen, station), station)
    channels = dict(BUOY_CHANNELS)
    if compat:
        channels["wind_speed"] = (MISSING_SPEED,)
    hourly = hourly_mean(
        chosen,
        [station],
        "timestamp_tz",
        channels,
        circular=("measured_wave_direction", "wind_direction") if circular else (),
    ).where("wave_height is not null and measured_wave_direction is not null")
    return idw(
        near,
        hourly,
        station,
        "timestamp_tz",
        list(channels),
        digits,
        unique=True,
        weigh_missing=compat,
    )
