"""Cells around stations, coast cover, lattices and grid points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.fixed_values import COAST_BUFFER_DEG, DISK_RINGS, WIND_STEP_DEG
from shoregrid.functions import grid
from shoregrid.operators.sized import join_dimension


def disk_join(
    cells: DataFrame,
    stations: DataFrame,
    station: str,
    rings: int = DISK_RINGS,
    neighbours: DataFrame | None = None,
    centres: DataFrame | None = None,
) -> DataFrame:
    """Stations within `rings` cells of each cell: (cell, station, dist, weight).

    `stations` has the station key, `station_cell`, `lon` and `lat`. Neighbourhood is symmetric,
    so the stations are handed out to the cells around them and only wanted cells are kept: a cell
    with very many stations never meets itself. For cell ids of another grid pass
    `neighbours(cell, station_cell)` and `centres(cell, centre_lon, centre_lat)`.
    """
    base = stations.select(station, "station_cell", "lon", "lat").distinct()
    if neighbours is None:
        handed = base.withColumn("cell", F.explode(grid.disk(F.col("station_cell"), rings)))
    else:
        handed = join_dimension(base, neighbours.select("station_cell", "cell"), ["station_cell"])
    wanted = join_dimension(handed, cells.select("cell").distinct(), ["cell"], "left_semi")
    if centres is None:
        placed = wanted.withColumn("centre_lon", grid.centre_lon(F.col("cell"))).withColumn(
            "centre_lat", grid.centre_lat(F.col("cell"))
        )
    else:
        placed = join_dimension(wanted, centres, ["cell"])
    dist = grid.great_circle_m(*[F.col(c) for c in ("lon", "lat", "centre_lon", "centre_lat")])
    return (
        placed.withColumn("dist", dist)
        .withColumn("weight", F.when(F.col("dist") != 0, F.lit(1.0) / (F.col("dist") * F.col("dist"))))
        .select("cell", station, "dist", "weight")
    )


def segments(lines: DataFrame, vertices: str, carry: list[str] | None = None) -> DataFrame:
    """Consecutive vertex pairs of each line as (carried columns, ax, ay, bx, by)."""
    a, b = F.col("_pair.a"), F.col("_pair.b")
    pairs = F.arrays_zip(
        F.slice(vertices, 1, F.greatest(F.size(vertices) - 1, F.lit(0))).alias("a"),
        F.slice(vertices, 2, F.greatest(F.size(vertices) - 1, F.lit(0))).alias("b"),
    )
    return lines.withColumn("_pair", F.explode(pairs)).select(
        *(carry or []),
        a["lon"].alias("ax"),
        a["lat"].alias("ay"),
        b["lon"].alias("bx"),
        b["lat"].alias("by"),
    )


def cover_buffer(
    segs: DataFrame, radius: float = COAST_BUFFER_DEG, carry: list[str] | None = None
) -> DataFrame:
    """Distinct cells whose centre is at most `radius` degrees from a segment.

    Candidates are the cells of the segment's own bounding box, so work follows segment length.
    A segment that spans more than half the globe in longitude is taken the short way round.
    """
    carried = carry or []
    step = F.col("bx") - F.col("ax")
    end = F.col("bx") - F.when(step > 180, F.lit(360.0)).when(step < -180, F.lit(-360.0)).otherwise(
        F.lit(0.0)
    )

    def index(value: Column, origin: float) -> Column:
        return F.floor((value + origin) * grid.PER_DEGREE)

    flat = segs.withColumn("bx", end)
    west = index(F.least("ax", "bx") - radius, 180.0)
    east = index(F.greatest("ax", "bx") + radius, 180.0)
    south = F.greatest(index(F.least("ay", "by") - radius, 90.0), F.lit(0))
    north = F.least(index(F.greatest("ay", "by") + radius, 90.0), F.lit(grid.ROWS - 1))
    px, py = (F.col("_ix") + 0.5) / 2 - 180.0, (F.col("_iy") + 0.5) / 2 - 90.0
    gap = grid.segment_distance_sq(px, py, *[F.col(c) for c in ("ax", "ay", "bx", "by")])
    return (
        flat.withColumn("_ix", F.explode(F.sequence(west, east)))
        .withColumn("_iy", F.explode(F.sequence(south, north)))
        .where(gap <= radius * radius)
        .select(
            *carried,
            (F.col("_iy") * grid.COLUMNS + F.pmod(F.col("_ix"), F.lit(grid.COLUMNS)))
            .cast("long")
            .alias("cell"),
        )
        .distinct()
    )


def dissolve(cells: DataFrame) -> DataFrame:
    """The mask of a set of cells: each one once."""
    return cells.select("cell").distinct()


def lattice(spark: SparkSession, step: float = WIND_STEP_DEG) -> DataFrame:
    """All points of a regular lon/lat lattice, each once: both poles, and the dateline as -180."""
    across, up = round(360 / step), round(180 / step) + 1
    n = F.col("id")
    lon = F.pmod(n, F.lit(across)) * F.lit(step) - 180.0
    lat = F.floor(n / F.lit(across)) * F.lit(step) - 90.0
    return spark.range(across * up).select(lon.alias("lon"), lat.alias("lat"))


def clip_to_cells(points: DataFrame, mask: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Points that lie in one of the mask's cells, with their cell."""
    placed = points.withColumn("cell", grid.cell_of(F.col(lon), F.col(lat)))
    return join_dimension(placed, dissolve(mask), ["cell"], "left_semi")


def nearest_grid(
    points: DataFrame, gridded: DataFrame, step: float, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Grid rows (grid_lon, grid_lat, ...) joined to the points they are nearest to, across the dateline too."""

    def axis(value: Column) -> Column:
        return F.floor(value / step + 0.5).cast("long")

    def around(value: Column) -> Column:
        return F.pmod(axis(value), F.lit(round(360 / step)))

    keyed = gridded.withColumns({"_gx": around(F.col("grid_lon")), "_gy": axis(F.col("grid_lat"))})
    wanted = points.withColumns({"_gx": around(F.col(lon)), "_gy": axis(F.col(lat))})
    return join_dimension(keyed, wanted, ["_gx", "_gy"]).drop("_gx", "_gy")
