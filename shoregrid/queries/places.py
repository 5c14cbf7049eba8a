"""Cells, distances, grids, coast cover and tile keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions import grid
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators import spatial
from shoregrid.queries import query
from shoregrid.queries.inputs import (
    LAT_SQL,
    LON_SQL,
    STATION_SQL,
    cell_sql,
    centre_lat_sql,
    centre_lon_sql,
    distance_sql,
    station_cells,
    station_lat,
    station_lon,
    stations,
    table,
)


@query(f"""
SELECT event_id, {cell_sql(LON_SQL, LAT_SQL)} AS cell,
       {centre_lon_sql(cell_sql(LON_SQL, LAT_SQL))} AS centre_lon,
       {centre_lat_sql(cell_sql(LON_SQL, LAT_SQL))} AS centre_lat,
       round({LON_SQL}, 6) AS lon, round({LAT_SQL}, 6) AS lat
FROM events
""")
def cells_and_centres(spark, sf_dir):
    """Cell and cell centre of points that went through their text form."""
    lon, lat = station_lon(F.col("user_id")), station_lat(F.col("user_id"))
    place = grid.point_from_text(grid.point_to_text(grid.point(lon, lat)))
    placed = table(spark, sf_dir, "events").select("event_id", place.alias("p"))
    cell = grid.cell_of(F.col("p.lon"), F.col("p.lat"))
    return placed.withColumn("cell", cell).select(
        "event_id",
        "cell",
        grid.cell_centre(F.col("cell"))["lon"].alias("centre_lon"),
        grid.cell_centre(F.col("cell"))["lat"].alias("centre_lat"),
        round_half_away(F.col("p.lon"), 6).alias("lon"),
        round_half_away(F.col("p.lat"), 6).alias("lat"),
    )


@query("""
SELECT event_id, cell, CAST(dy * 720 + (cell % 720 + dx + 720) % 720 + cell // 720 * 720 AS BIGINT) AS neighbour
FROM (SELECT event_id, (event_id * 7919) % 259200 AS cell FROM events)
CROSS JOIN (SELECT unnest(range(-2, 3)) AS dy) CROSS JOIN (SELECT unnest(range(-2, 3)) AS dx)
WHERE cell // 720 + dy BETWEEN 0 AND 359
""")
def cell_disks(spark, sf_dir):
    """Neighbourhoods of cells all over the globe, poles and dateline included."""
    cells = table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") * 7919 % (grid.ROWS * grid.COLUMNS)).alias("cell")
    )
    return cells.withColumn("neighbour", F.explode(grid.disk(F.col("cell"), 2)))


@query(f"""
WITH {STATION_SQL}
SELECT cell, user_id, round(dist, 3) AS metres FROM near
""")
def disk_join(spark, sf_dir):
    """Stations around each wanted cell with their distance to its centre."""
    near = spatial.disk_join(station_cells(spark, sf_dir), stations(spark, sf_dir), "user_id")
    return near.select("cell", "user_id", round_half_away(F.col("dist"), 3).alias("metres"))


@query(f"""
SELECT event_id, round({distance_sql(LON_SQL, LAT_SQL, "-157.5e0", "21.25e0")}, 3) AS metres FROM events
""")
def great_circle(spark, sf_dir):
    lon, lat = station_lon(F.col("user_id")), station_lat(F.col("user_id"))
    metres = grid.great_circle_m(lon, lat, F.lit(-157.5), F.lit(21.25))
    return table(spark, sf_dir, "events").select(
        "event_id", round_half_away(metres, 3).alias("metres")
    )


@query(f"""
WITH {STATION_SQL}
SELECT lon, lat, cell FROM (
    SELECT lon, lat, {cell_sql("lon", "lat")} AS cell
    FROM (SELECT i * 0.25e0 - 180e0 AS lon FROM range(0, 1440) t(i))
    CROSS JOIN (SELECT j * 0.25e0 - 90e0 AS lat FROM range(0, 720) t(j)))
WHERE cell IN (SELECT station_cell FROM station)
""")
def lattice_cells(spark, sf_dir):
    """Points of a global lattice that lie in station cells."""
    mask = stations(spark, sf_dir).select(F.col("station_cell").alias("cell"))
    return spatial.clip_to_cells(spatial.lattice(spark), mask)


@query(f"""
WITH {STATION_SQL},
pair AS (SELECT a.lon AS ax, a.lat AS ay, b.lon AS bx, b.lat AS "by"
         FROM station a JOIN station b ON b.user_id = a.user_id + 1 AND b.lat = a.lat),
seg AS (SELECT DISTINCT * FROM pair),
box AS (
    SELECT *, CAST(floor((least(ax, bx) + 179.4e0) * 2) AS BIGINT) AS x0,
           CAST(floor((greatest(ax, bx) + 180.6e0) * 2) AS BIGINT) + 1 AS x1,
           CAST(floor((least(ay, "by") + 89.4e0) * 2) AS BIGINT) AS y0,
           CAST(floor((greatest(ay, "by") + 90.6e0) * 2) AS BIGINT) + 1 AS y1 FROM seg),
cand AS (
    SELECT *, iy * 720 + ix AS cell, (ix + 0.5e0) / 2 - 180e0 AS px, (iy + 0.5e0) / 2 - 90e0 AS py
    FROM (SELECT *, unnest(range(x0, x1)) AS ix FROM (SELECT *, unnest(range(y0, y1)) AS iy FROM box))),
along AS (
    SELECT *, least(greatest(coalesce(((px - ax) * (bx - ax) + (py - ay) * ("by" - ay))
              / nullif((bx - ax) * (bx - ax) + ("by" - ay) * ("by" - ay), 0), 0), 0), 1) AS t FROM cand)
SELECT DISTINCT cell FROM along
WHERE (px - ax - t * (bx - ax)) * (px - ax - t * (bx - ax))
    + (py - ay - t * ("by" - ay)) * (py - ay - t * ("by" - ay)) <= 0.36e0
""")
def coast_cover(spark, sf_dir):
    """Cells within 0.6 degrees of the segments between consecutive stations."""
    from shoregrid.plans.dimensions import coast_cells

    base = stations(spark, sf_dir).select("user_id", "lon", "lat")
    after = base.select(
        (F.col("user_id") - 1).alias("user_id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")
    )
    lines = (
        base.join(after, "user_id")
        .where("lat = lat2")
        .select(
            F.array(
                grid.point(F.col("lon"), F.col("lat")), grid.point(F.col("lon2"), F.col("lat2"))
            ).alias("line")
        )
        .distinct()
    )
    return coast_cells(lines).select("cell")


@query(f"""
SELECT DISTINCT user_id, gx * 0.25e0 AS grid_lon, gy * 0.25e0 AS grid_lat FROM (
    SELECT user_id, floor({LON_SQL} / 0.25e0 + 0.5e0) AS gx, floor({LAT_SQL} / 0.25e0 + 0.5e0) AS gy FROM events)
""")
def nearest_grid(spark, sf_dir):
    """Grid point nearest to each station."""
    points = stations(spark, sf_dir).select("user_id", "lon", "lat")
    gridded = spatial.lattice(spark).select(
        F.col("lon").alias("grid_lon"), F.col("lat").alias("grid_lat")
    )
    return spatial.nearest_grid(points, gridded, 0.25).select("user_id", "grid_lon", "grid_lat")


@query("""
SELECT event_id, round(CASE WHEN lon >= 180e0 THEN lon - 360e0 ELSE lon END, 6) AS lon
FROM (SELECT event_id, (value * 3e0) % 360e0 AS lon FROM events)
""")
def normalised_longitudes(spark, sf_dir):
    lon = F.col("value") * 3.0 % 360.0
    return table(spark, sf_dir, "events").select(
        "event_id", round_half_away(grid.normalise_lon(lon), 6).alias("lon")
    )


@query(f"""
SELECT event_id, string_agg(CAST(((x >> b) & 1) + 2 * ((y >> b) & 1) AS VARCHAR), '' ORDER BY b DESC) AS quadkey
FROM (SELECT event_id, CAST(floor((lon + 180e0) / 360e0 * 64) AS BIGINT) AS x,
             CAST(floor((0.5e0 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 64) AS BIGINT) AS y
      FROM (SELECT event_id, {LON_SQL} AS lon, {LAT_SQL} AS lat FROM events)),
     (SELECT unnest(range(0, 6)) AS b)
GROUP BY event_id
""")
def quadkeys(spark, sf_dir):
    lon, lat = station_lon(F.col("user_id")), station_lat(F.col("user_id"))
    return table(spark, sf_dir, "events").select("event_id", grid.quadkey(lon, lat, 6).alias("quadkey"))


@query(f"""
WITH {STATION_SQL},
pair AS (SELECT a.user_id AS line_id, a.lon AS ax, a.lat AS ay, b.lon AS bx, b.lat AS "by"
         FROM station a JOIN station b ON b.user_id = a.user_id + 1 AND b.lat = a.lat),
seg AS (SELECT DISTINCT * FROM pair),
box AS (
    SELECT *, CAST(floor((least(ax, bx) + 179.4e0) * 2) AS BIGINT) AS x0,
           CAST(floor((greatest(ax, bx) + 180.6e0) * 2) AS BIGINT) + 1 AS x1,
           CAST(floor((least(ay, "by") + 89.4e0) * 2) AS BIGINT) AS y0,
           CAST(floor((greatest(ay, "by") + 90.6e0) * 2) AS BIGINT) + 1 AS y1 FROM seg),
cand AS (
    SELECT *, iy * 720 + ix AS cell, (ix + 0.5e0) / 2 - 180e0 AS px, (iy + 0.5e0) / 2 - 90e0 AS py
    FROM (SELECT *, unnest(range(x0, x1)) AS ix FROM (SELECT *, unnest(range(y0, y1)) AS iy FROM box))),
along AS (
    SELECT *, least(greatest(coalesce(((px - ax) * (bx - ax) + (py - ay) * ("by" - ay))
              / nullif((bx - ax) * (bx - ax) + ("by" - ay) * ("by" - ay), 0), 0), 0), 1) AS t FROM cand)
SELECT DISTINCT line_id, cell FROM along
WHERE (px - ax - t * (bx - ax)) * (px - ax - t * (bx - ax))
    + (py - ay - t * ("by" - ay)) * (py - ay - t * ("by" - ay)) <= 0.36e0
""")
def coast_shapes(spark, sf_dir):
    """Which cells each line between consecutive stations covers."""
    from shoregrid.plans.dimensions import coast_shapes as shapes

    base = stations(spark, sf_dir).select("user_id", "lon", "lat")
    after = base.select(
        (F.col("user_id") - 1).alias("user_id"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2")
    )
    ends = [grid.point(F.col("lon"), F.col("lat")), grid.point(F.col("lon2"), F.col("lat2"))]
    lines = (
        base.join(after, "user_id")
        .where("lat = lat2")
        .select(F.col("user_id").alias("line_id"), F.array(*ends).alias("line"))
    )
    return shapes(lines, "line_id")
