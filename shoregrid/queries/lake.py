"""A lake of tables below one folder: filled from raw files, refreshed by ranges, mended where days are missing."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions import grid, text
from shoregrid.functions.numbers import round_half_away
from shoregrid.plans import registry
from shoregrid.queries import query
from shoregrid.queries.inputs import (
    BUOY_SQL,
    GAUGE_SQL,
    LAT_SQL,
    LON_SQL,
    ONE_PER_TIME_SQL,
    STATION_SQL,
    WIND_UV_SQL,
    buoy_text,
    cell_sql,
    gauge_stations,
    idw_sql,
    one_per_time,
    station_cells,
    station_lat,
    station_lon,
    station_records,
    stations,
    table,
)
from shoregrid.queries.models import buoy_idw_sql
from shoregrid.session import work_path
from shoregrid.sources.files import bundled

NTZ = "timestamp_ntz"


def _day(text_day: str):
    return F.to_timestamp(F.lit(text_day))


def _gauge_lake(spark, sf_dir, where: str):
    """A lake with gauge stations and the readings of some days; further days can be written over them."""
    lake = registry.Lake(spark, work_path(spark, "gauge-lake"))
    gauge_stations(spark, sf_dir).write.parquet(lake.path("tide_stations"))
    _land_gauges(lake, sf_dir, where)
    return lake


def _land_gauges(lake, sf_dir, where: str):
    user = F.col("user_id")
    readings = table(lake.spark, sf_dir, "events").where(where).groupBy((user % 1000).alias("user_id"), "ts")
    station = F.concat(text.zero_pad(user, 3), F.lit("a")).alias("station_id")
    readings.agg(F.max("value").alias("value")).select(
        station, F.col("ts").cast("timestamp").alias("timestamp_tz"), F.floor(F.col("value") * 100).alias("reading_mm")
    ).write.mode("overwrite").parquet(lake.path("bronze/tides"))


def _per_day(lake):
    rows = lake.table("tide_measurements").groupBy(F.to_date("timestamp_tz").alias("day"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.sum("reading_mm").alias("total"))


PER_DAY_SQL = """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS total
FROM (SELECT user_id % 1000 AS user_id, ts, max(value) AS value FROM events GROUP BY 1, 2) WHERE {} GROUP BY 1
"""


@query(PER_DAY_SQL.format("day(ts) % 5 <> 0 OR ts >= TIMESTAMP '2024-01-21'"))
def withdrawn_days(spark, sf_dir):
    """Days whose readings are withdrawn become empty when their range is refreshed; those outside it stay."""
    lake = _gauge_lake(spark, sf_dir, "true")
    registry.refresh(lake, ["tide_measurements"], [(_day("2024-01-01"), _day("2024-02-02"))])
    _land_gauges(lake, sf_dir, "day(ts) % 5 <> 0")
    registry.refresh(lake, ["tide_measurements"], [(_day("2024-01-01"), _day("2024-01-21"))])
    return _per_day(lake)


@query("""
WITH held AS (
    SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 7 <> 0),
gap AS (
    SELECT day FROM held WHERE NOT (day BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'
                                    OR day BETWEEN DATE '2024-01-20' AND DATE '2024-01-24')),
run AS (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS island FROM gap)
SELECT CAST(min(day) AS TIMESTAMP) AS slice_start, CAST(max(day) + 1 AS TIMESTAMP) AS slice_end FROM run GROUP BY island
""")
def missing_days(spark, sf_dir):
    """Runs of days that readings are there for and the table has not."""
    lake = _gauge_lake(spark, sf_dir, "day(ts) % 7 <> 0")
    ranges = [(_day("2024-01-05"), _day("2024-01-09")), (_day("2024-01-20"), _day("2024-01-25"))]
    registry.refresh(lake, ["tide_measurements"], ranges)
    found = registry.missing(lake, "tide_measurements")
    return found.select(*[F.col(c).cast(NTZ).alias(c) for c in found.columns])


@query(PER_DAY_SQL.format("true"))
def filled_days(spark, sf_dir):
    """A table with holes, filled by refreshing exactly what is missing, twice."""
    lake = _gauge_lake(spark, sf_dir, "day(ts) % 7 <> 0")
    registry.refresh(lake, ["tide_measurements"], [(_day("2024-01-05"), _day("2024-01-09"))])
    registry.refresh_missing(lake, ["tide_measurements"])
    _land_gauges(lake, sf_dir, "true")
    registry.refresh_missing(lake, ["tide_measurements"])
    return _per_day(lake)


@query(f"""
WITH {STATION_SQL}, {ONE_PER_TIME_SQL},
{BUOY_SQL.replace("FROM events)", "FROM reading)", 1)}, {buoy_idw_sql(2)},
{GAUGE_SQL.replace("CAST(floor(value * 40) AS BIGINT) - 2800 AS reading_mm", "max(CAST(floor(value * 40) AS BIGINT) - 2800) AS reading_mm", 1)
.replace("FROM events)", "FROM events GROUP BY 1, 2)", 1)},
tide_idw AS (
    SELECT cell, timestamp_tz, {idw_sql("reading_mm", 2)} AS idw_mm
    FROM gauge_row JOIN gauge_near USING (user_id) WHERE reading_mm >= -2743 GROUP BY cell, timestamp_tz),
wanted_point AS (
    SELECT DISTINCT floor(lon / 0.25e0 + 0.5e0) AS gx, floor(lat / 0.25e0 + 0.5e0) AS gy FROM station),
gridded AS (
    SELECT date_trunc('hour', ts) AS timestamp_tz, event_id % 2 = 0 AS eastward, (value - 60e0) / 10e0 AS part,
           round({LON_SQL} * 4) / 4e0 AS lon, round({LAT_SQL} * 4) / 4e0 AS lat FROM events),
wind_part AS (
    SELECT {cell_sql("p.lon", "p.lat")} AS cell, p.* FROM gridded p JOIN wanted_point w
      ON floor(p.lon / 0.25e0 + 0.5e0) = w.gx AND floor(p.lat / 0.25e0 + 0.5e0) = w.gy
    WHERE {cell_sql("p.lon", "p.lat")} IN (SELECT cell FROM wanted)), {WIND_UV_SQL},
condition AS (
    SELECT b.cell, b.timestamp_tz, b.idw_wave_height AS f2, b.idw_average_wave_period AS f3,
           b.idw_measured_wave_direction AS f4, coalesce(round(t.idw_mm / 1000e0, 2), b.idw_tide) AS f5,
           round(coalesce(w.wind_speed_ms, b.idw_wind_speed), 2) AS f6,
           round(coalesce(w.wind_dir, b.idw_wind_direction), 2) AS f7
    FROM buoy_idw b LEFT JOIN tide_idw t USING (cell, timestamp_tz) LEFT JOIN wind w USING (cell, timestamp_tz))
SELECT cell, timestamp_tz AS hour, f2, f3, f4, f5, f6, f7 FROM condition
WHERE f2 IS NOT NULL AND f3 IS NOT NULL AND f4 IS NOT NULL AND f5 IS NOT NULL AND f6 IS NOT NULL AND f7 IS NOT NULL
""")
def lake_tags(spark, sf_dir):
    """A lake filled from raw text, CSV and grids up to the tags, by models and ranges alone."""
    lake = registry.Lake(spark, work_path(spark, "lake"))
    user, events = F.col("user_id"), table(spark, sf_dir, "events")
    lines = buoy_text(spark, sf_dir, one_per_time(spark, sf_dir))
    name = F.concat(F.lit("stdmet/"), F.replace(F.substring_index("filename", "/", -1), F.lit(".gz"), F.lit("")))
    bundled(lines.withColumn("filename", name)).write.text(lake.path("raw/buoy_bundles"))
    hours = events.groupBy((user % 1000).alias("user_id"), F.date_trunc("HOUR", "ts").alias("ts"))
    gauges = hours.agg(F.max(F.floor(F.col("value") * 40) - 2800).alias("reading_mm")).select(
        F.concat(text.zero_pad(user, 3), F.lit("a.csv")).alias("gauge"),
        *[f("ts") for f in (F.year, F.month, F.dayofmonth, F.hour)],
        "reading_mm",
    )
    gauges.repartition("gauge").write.partitionBy("gauge").csv(lake.path("raw/tides"))
    quarter = lambda c: round_half_away(c * 4, 0) / 4.0
    events.select(
        F.date_format("ts", "yyyyMMddHH").alias("hour"),
        (quarter(station_lon(user)) + 360.0).alias("longitude"),
        quarter(station_lat(user)).alias("latitude"),
        ((F.col("value") - 60.0) / 10.0).alias("value"),
        F.when(F.col("event_id") % 2 == 0, "VAR_10U").otherwise("VAR_10V").alias("component"),
    ).write.partitionBy("component").parquet(lake.path("raw/wind"))
    station_cells(spark, sf_dir).write.parquet(lake.path("bronze/coast_cells"))
    station_records(spark, sf_dir).write.parquet(lake.path("bronze/station_history"))
    gauge_stations(spark, sf_dir).write.parquet(lake.path("bronze/tide_stations"))
    snapped = [grid.snap(F.col(c), 0.25).alias(c) for c in ("lon", "lat")]
    stations(spark, sf_dir).select(*snapped).distinct().write.parquet(lake.path("bronze/wind_lookup"))
    registry.refresh(lake, [n for n in registry.MODELS if n != "coast_shapes"], [(_day("2024-01-01"), _day("2024-01-16"))])
    registry.refresh_missing(lake, ["buoy_measurements", "tide_measurements", "wind", "tide_idw", "buoy_idw", "tags"])
    return lake.table("tags").select(
        "cell", F.col("timestamp_tz").cast(NTZ).alias("hour"), *[F.get("tag", i).alias(f"f{i + 1}") for i in range(1, 7)]
    )
