"""Station dimensions and coast tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.fixed_values import COAST_BUFFER_DEG, WIND_STEP_DEG
from shoregrid.functions import grid, moments, text
from shoregrid.operators.spatial import clip_to_cells, cover_buffer, lattice, segments


def station_history(stations: DataFrame) -> DataFrame:
    """Slowly changing station records out of station elements with nested history.

    A station's history sits in one row, so its records are numbered by start inside the array:
    no window, no shuffle.
    """
    ordered = F.array_sort(
        F.transform(
            "history",
            lambda h: F.struct(h["_start"].alias("_order"), h.alias("h")),
        )
    )
    rows = stations.select("*", F.posexplode(ordered).alias("_pos", "_row")).withColumn(
        "hist", F.col("_row.h")
    )
    lon, lat = F.col("hist._lng").try_cast("double"), F.col("hist._lat").try_cast("double")
    return rows.select(
        (F.col("_pos") + 1).alias("station_sk"),
        F.col("_id").alias("station_id"),
        F.col("_name").alias("name"),
        F.col("_owner").alias("owner"),
        F.col("_pgm").alias("pgm"),
        F.col("_type").alias("type"),
        moments.iso_day(F.col("hist._start")).alias("start_time"),
        moments.iso_day(F.col("hist._stop")).alias("end_time"),
        grid.point(lon, lat).alias("geometry"),
        grid.cell_of(lon, lat).alias("cell"),
        F.col("hist._elev").try_cast("double").alias("elev"),
        F.col("hist._met").alias("met"),
        F.col("hist._hull").alias("hull"),
        F.col("hist._anemom_height").try_cast("double").alias("anemom_height"),
    )


TIDE_STATION_COLUMNS = [
    "UH#", "GLOSS#", "Version", "Location", "Country", "Longitude", "Latitude", "Start", "End",
]


def tide_stations(research: DataFrame, fast: DataFrame) -> DataFrame:
    """Gauge stations of the research and the fast-delivery list, both as text tables.

    Station ids pad the number to three digits, as the measurement file names do.
    """

    def shape(df: DataFrame, uh_id: Column, version: Column, station_id: Column) -> DataFrame:
        lon, lat = F.col("Longitude").try_cast("double"), F.col("Latitude").try_cast("double")
        return df.select(
            uh_id.alias("uh_id"),
            F.col("GLOSS#").try_cast("long").alias("gloss_id"),
            version.alias("version"),
            station_id.alias("station_id"),
            F.col("Location").alias("location"),
            F.col("Country").alias("country"),
            grid.point(lon, lat).alias("geometry"),
            grid.cell_of(lon, lat).alias("cell"),
            moments.iso_day(F.col("Start")).alias("start_time"),
            moments.iso_day(F.col("End")).alias("end_time"),
        )

    number = text.zero_pad(F.col("UH#"), 3)
    quick = F.concat(F.lit("h"), number)
    return shape(
        research, number, F.col("Version"), F.concat(number, F.col("Version"))
    ).unionByName(shape(fast, quick, F.lit("fast"), F.concat(quick, F.lit("fast"))))


def coast_cells(lines: DataFrame, vertices: str = "line", radius: float = COAST_BUFFER_DEG) -> DataFrame:
    """Cells within the coast buffer, each once, with their centre."""
    cells = cover_buffer(segments(lines, vertices), radius)
    return cells.withColumn("geometry", grid.cell_centre(F.col("cell")))


def coast_shapes(lines: DataFrame, line_id: str, vertices: str = "line") -> DataFrame:
    """Which cells each coastline covers: (line id, cell)."""
    return cover_buffer(segments(lines, vertices, [line_id]), COAST_BUFFER_DEG, [line_id])


def wind_lookup(spark: SparkSession, cells: DataFrame, step: float = WIND_STEP_DEG) -> DataFrame:
    """Lattice points of the wind grid that lie in coast cells, one row each."""
    return clip_to_cells(lattice(spark, step), cells)
