"""Water-level station inventory and predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.fixed_values import TIDE_PARAMETER
from shoregrid.functions import grid, moments, text
from shoregrid.functions.arrays import first_match
from shoregrid.operators.sized import join_dimension

PREDICTION_QUERY = (
    "?product=predictions&begin_date={begin}&end_date={end}&datum=MLLW&station={station}"
    "&time_zone=GMT&units=english&interval=&format=csv"
)


def water_level_inventory(parsed: DataFrame, parameter: str = TIDE_PARAMETER) -> DataFrame:
    """Stations with the time range of one parameter, out of parsed inventory documents."""
    found = first_match(F.col("parameters"), lambda p: p["_name"] == parameter)
    return parsed.withColumn("_p", found).select(
        "station_id",
        grid.point(F.col("lon"), F.col("lat")).alias("geom"),
        moments.zoned_minute(F.col("_p._first")).alias("time_start"),
        moments.zoned_minute(F.col("_p._last")).alias("time_end"),
    )


def prediction_requests(
    inventory: DataFrame, endpoint: str, start, end, box: tuple[float, float, float, float]
) -> DataFrame:
    """Request addresses of the stations in a box (west, south, east, north) and time range."""
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    chosen = inventory.where(
        moments.overlaps(F.col("time_start"), F.col("time_end"), first, last)
        & grid.within_box(F.col("geom.lon"), F.col("geom.lat"), *box)
    )
    address = F.lit(endpoint + PREDICTION_QUERY)
    for mark, value in (
        ("{begin}", F.date_format(first, "yyyyMMdd")),
        ("{end}", F.date_format(last, "yyyyMMdd")),
        ("{station}", F.col("station_id")),
    ):
        address = F.replace(address, F.lit(mark), value)
    return chosen.select("station_id", address.alias("archive_url"))


def predictions(rows: DataFrame, inventory: DataFrame) -> DataFrame:
    """Prediction rows (filename, date_time, prediction) joined to the station in their file name."""
    station = text.part(text.part(F.col("filename"), "station=", 2), "&", 1)
    keyed = rows.select(
        station.alias("station_id"),
        moments.zoned_minute(F.col("date_time")).alias("timestamp_tz"),
        F.col("prediction").alias("water_level_m"),
    )
    placed = inventory.select(
        "station_id", grid.cell_of(F.col("geom.lon"), F.col("geom.lat")).alias("cell")
    )
    return join_dimension(keyed, placed, ["station_id"]).select(
        "station_id", "cell", "timestamp_tz", "water_level_m"
    )
