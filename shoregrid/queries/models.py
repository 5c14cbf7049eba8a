"""Whole models over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.fixed_values import MATCH_WINDOW_MINUTES, OBSERVATION_FILLS
from shoregrid.functions import grid
from shoregrid.functions.moments import truncate
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators.search import search_by_media as media_search
from shoregrid.operators.search import vector_search as search
from shoregrid.operators.vector_index import VectorIndex, photo_search
from shoregrid.operators.vector_index import build as build_index
from shoregrid.plans import bronze, dimensions, gold, registry, silver
from shoregrid.queries import query
from shoregrid.queries.inputs import (
    BUOY_SQL,
    GAUGE_SQL,
    LAT_SQL,
    LON_SQL,
    STATION_SQL,
    WIND_SQL,
    buoy_text,
    cell_sql,
    cents,
    centre_lat_sql,
    centre_lon_sql,
    distance_sql,
    gauge_files,
    gauge_stations,
    idw_sql,
    station_cells,
    station_lat,
    station_lon,
    station_records,
    table,
    wind_rows,
)
from shoregrid.operators.sized import written
from shoregrid.session import work_path
from shoregrid.sinks.tables import append_partitioned
from shoregrid.sources.documents import parse_station_xml
from shoregrid.sources.files import observation_lines

NTZ = "timestamp_ntz"


def _bronze(spark, sf_dir):
    return bronze.buoy_bronze(observation_lines(buoy_text(spark, sf_dir), "value"))


@query(f"""
WITH {BUOY_SQL}
SELECT station_name AS station_id, date_trunc('year', seen) AS year, seen,
       CAST(CASE WHEN user_id % 2 = 0 THEN 18 ELSE 17 END AS INTEGER) AS n_fields, count(*) AS n
FROM sighting GROUP BY ALL
""")
def buoy_bronze(spark, sf_dir):
    """Raw buoy text to rows, written by year and read back."""
    path = work_path(spark, "buoy-bronze")
    rows = _bronze(spark, sf_dir)
    append_partitioned(
        rows.select("filename", "station_id", "timestamp_tz", "line", F.year("year").alias("year")),
        path,
        ["year"],
        ["station_id", "timestamp_tz"],
    )
    return (
        spark.read.parquet(path)
        .groupBy("station_id", "year", "timestamp_tz", F.size("line").alias("n_fields"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "station_id",
            F.make_date("year", F.lit(1), F.lit(1)).cast(NTZ).alias("year"),
            F.col("timestamp_tz").cast(NTZ).alias("seen"),
            "n_fields",
            "n",
        )
    )


@query(f"""
WITH {GAUGE_SQL.split("gauge AS (")[0].rstrip().rstrip(",")}
SELECT printf('%03d', user_id) AS uh_id, 'a' AS version, printf('%03d', user_id) || 'a' AS station_id,
       timestamp_tz AS seen, reading_mm
FROM gauge_row
""")
def tide_bronze(spark, sf_dir):
    """Gauge files with station number and version in their names."""
    rows = bronze.tide_bronze(gauge_files(spark, sf_dir))
    return rows.select(
        "uh_id", "version", "station_id", F.col("timestamp_tz").cast(NTZ).alias("seen"), "reading_mm"
    )


@query(f"""
WITH {STATION_SQL},
wanted_point AS (
    SELECT DISTINCT floor(lon / 0.25e0 + 0.5e0) AS gx, floor(lat / 0.25e0 + 0.5e0) AS gy FROM station),
placed AS (
    SELECT date_trunc('hour', ts) AS utc_date, round({LON_SQL} * 4) / 4e0 AS lon,
           round({LAT_SQL} * 4) / 4e0 AS lat, value FROM events)
SELECT p.utc_date, date_trunc('month', p.utc_date) AS utc_month, 'VAR_10U' AS wind_dim, p.lon AS longitude,
       p.lat AS latitude, {cell_sql("p.lon", "p.lat")} AS cell, p.value AS wind_dim_val
FROM placed p JOIN wanted_point w
  ON floor(p.lon / 0.25e0 + 0.5e0) = w.gx AND floor(p.lat / 0.25e0 + 0.5e0) = w.gy
WHERE {cell_sql("p.lon", "p.lat")} IN (SELECT station_cell FROM station)
""")
def wind_bronze(spark, sf_dir):
    """Grid values on a 0-360 longitude axis, clipped to cells and cut to the wanted points."""
    user = F.col("user_id")
    quarter = lambda c: round_half_away(c * 4, 0) / 4.0
    gridded = table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMddHH").alias("hour"),
        (quarter(station_lon(user)) + 360.0).alias("longitude"),
        quarter(station_lat(user)).alias("latitude"),
        "value",
    )
    from shoregrid.queries.inputs import stations

    known = stations(spark, sf_dir)
    lookup = known.select(
        grid.snap(F.col("lon"), 0.25).alias("lon"), grid.snap(F.col("lat"), 0.25).alias("lat")
    ).distinct()
    mask = known.select(F.col("station_cell").alias("cell"))
    rows = bronze.wind_bronze(gridded, mask, lookup, "VAR_10U")
    return rows.withColumns({c: F.col(c).cast(NTZ) for c in ("utc_date", "utc_month")})


MEASURES = [name for name, _, _ in OBSERVATION_FILLS]


@query(f"""
WITH {BUOY_SQL}
SELECT station_id, timestamp_tz AS seen, CAST(station_sk AS INTEGER) AS station_sk, round(lon, 6) AS lon, round(lat, 6) AS lat,
       {cell_sql("lon", "lat")} AS cell,
       {", ".join(f"CAST({m} AS INTEGER) AS {m}" if "direction" in m else m for m in MEASURES)}
FROM measured
""")
def buoy_measurements(spark, sf_dir):
    """Parsed buoy lines of both layouts with the station record that held."""
    rows = silver.buoy_measurements(_bronze(spark, sf_dir), station_records(spark, sf_dir))
    return rows.select(
        "station_id",
        F.col("timestamp_tz").cast(NTZ).alias("seen"),
        "station_sk",
        round_half_away(F.col("geometry.lon"), 6).alias("lon"),
        round_half_away(F.col("geometry.lat"), 6).alias("lat"),
        "cell",
        *MEASURES,
    )


@query(f"""
WITH {STATION_SQL}, {GAUGE_SQL}
SELECT printf('%03d', user_id) || 'a' AS station_id, timestamp_tz AS seen, reading_mm, station_cell AS cell
FROM gauge_row JOIN gauge USING (user_id)
WHERE timestamp_tz BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-28'
""")
def tide_measurements(spark, sf_dir):
    """Gauge rows of a time range with their station's place."""
    rows = silver.tide_measurements(
        bronze.tide_bronze(gauge_files(spark, sf_dir)),
        gauge_stations(spark, sf_dir),
        F.to_timestamp(F.lit("2024-01-02")),
        F.to_timestamp(F.lit("2024-01-28")),
    )
    return rows.select(
        "station_id", F.col("timestamp_tz").cast(NTZ).alias("seen"), "reading_mm", "cell"
    )


@query(f"""
WITH {WIND_SQL}
SELECT cell, timestamp_tz AS hour, round(wind_speed_ms, 6) AS wind_speed_ms, round(wind_dir, 6) AS wind_dir,
       round(lon, 6) AS lon, round(lat, 6) AS lat FROM wind
""")
def wind_measurements(spark, sf_dir):
    """Speed and direction per cell and hour from two components."""
    rows = silver.wind_measurements(wind_rows(spark, sf_dir))
    return rows.select(
        "cell",
        F.col("timestamp_tz").cast(NTZ).alias("hour"),
        round_half_away(F.col("wind_speed_ms"), 6).alias("wind_speed_ms"),
        round_half_away(F.col("wind_dir"), 6).alias("wind_dir"),
        round_half_away(F.col("geometry.lon"), 6).alias("lon"),
        round_half_away(F.col("geometry.lat"), 6).alias("lat"),
    )


def _tide_idw(spark, sf_dir, digits=6):
    known = gauge_stations(spark, sf_dir)
    rows = silver.tide_measurements(bronze.tide_bronze(gauge_files(spark, sf_dir)), known)
    return silver.tide_idw(station_cells(spark, sf_dir), known, rows, digits=digits)


TIDE_IDW_SQL = f"""
tide_idw AS (
    SELECT cell, timestamp_tz, {idw_sql("reading_mm", 6)} AS idw_mm
    FROM gauge_row JOIN gauge_near USING (user_id) WHERE reading_mm >= -2743
    GROUP BY cell, timestamp_tz)
"""


@query(f"""
WITH {STATION_SQL}, {GAUGE_SQL}, {TIDE_IDW_SQL}
SELECT cell, timestamp_tz AS hour, idw_mm FROM tide_idw
""")
def tide_idw(spark, sf_dir):
    """Tide per cell and hour from the gauges around it."""
    return _tide_idw(spark, sf_dir).select("cell", F.col("timestamp_tz").cast(NTZ).alias("hour"), "idw_mm")


CHANNELS = list(silver.BUOY_CHANNELS)

def buoy_idw_sql(digits: int, by_record: bool = True) -> str:
    """Hours per cell; by station record (where a reading was taken) or by station alone."""
    measured = "(SELECT * REPLACE (station_id || '|' || station_sk AS station_id) FROM measured)"
    measured = measured if by_record else "measured"
    return f"""
buoy_place AS (SELECT DISTINCT station_id, lon, lat, {cell_sql("lon", "lat")} AS station_cell FROM {measured}),
buoy_near AS (
    SELECT cell, station_id, dist, CASE WHEN dist <> 0 THEN 1e0 / (dist * dist) END AS weight FROM (
        SELECT w.cell, s.station_id,
               {distance_sql("s.lon", "s.lat", centre_lon_sql("w.cell"), centre_lat_sql("w.cell"))} AS dist
        FROM wanted w JOIN buoy_place s
          ON abs(w.cell // 720 - s.station_cell // 720) <= 2
         AND abs(w.cell % 720 - s.station_cell % 720) <= 2)),
buoy_hour AS (
    SELECT station_id, date_trunc('hour', timestamp_tz + INTERVAL 30 MINUTE) AS timestamp_tz,
           avg(nullif(wave_height, 99)) AS wave_height, avg(nullif(average_wave_period, 99)) AS average_wave_period,
           avg(nullif(measured_wave_direction, 999)) AS measured_wave_direction,
           avg(nullif(wind_direction, 999)) AS wind_direction,
           avg(CASE WHEN wind_speed NOT IN (99e0, 999.9e0) THEN wind_speed END) AS wind_speed,
           avg(CASE WHEN wind_speed <> 99e0 THEN wind_speed END) AS old_wind_speed,
           avg(nullif(tide, 99)) AS tide
    FROM {measured} GROUP BY 1, 2
    HAVING avg(nullif(wave_height, 99)) IS NOT NULL AND avg(nullif(measured_wave_direction, 999)) IS NOT NULL),
buoy_idw AS (
    SELECT cell, timestamp_tz, {", ".join(f"{idw_sql(c, digits)} AS idw_{c}" for c in CHANNELS)}
    FROM buoy_hour JOIN buoy_near USING (station_id) GROUP BY cell, timestamp_tz)
"""


BUOY_IDW_SQL = buoy_idw_sql(6)


def _buoy_idw(spark, sf_dir, compat=False):
    rows = silver.buoy_measurements(_bronze(spark, sf_dir), station_records(spark, sf_dir))
    rows = written(rows, "buoy-measurements")
    return silver.buoy_idw(station_cells(spark, sf_dir), rows, digits=6, compat=compat)


@query(f"""
WITH {STATION_SQL}, {BUOY_SQL}, {BUOY_IDW_SQL}
SELECT cell, timestamp_tz AS hour, {", ".join(f"idw_{c}" for c in CHANNELS)} FROM buoy_idw
""")
def buoy_idw(spark, sf_dir):
    """Six buoy channels per cell and hour, from raw text on."""
    return _buoy_idw(spark, sf_dir).select(
        "cell", F.col("timestamp_tz").cast(NTZ).alias("hour"), *[f"idw_{c}" for c in CHANNELS]
    )


@query(f"""
WITH {STATION_SQL}, {BUOY_SQL}, {buoy_idw_sql(2)}
SELECT cell, timestamp_tz AS hour, {", ".join(f"idw_{c}" for c in CHANNELS)} FROM buoy_idw
""")
def refreshed_buoy_hours(spark, sf_dir):
    """Buoy hours refreshed by touching ranges, then again when late readings are in: as if built at once."""
    lake = registry.Lake(spark, work_path(spark, "buoy-lake"))
    station_cells(spark, sf_dir).write.parquet(lake.path("coast_cells"))
    rows = silver.buoy_measurements(_bronze(spark, sf_dir), station_records(spark, sf_dir))
    late = F.minute("timestamp_tz") % 4 == 0
    day = lambda d: F.to_timestamp(F.lit(d))
    ranges = [(day("2024-01-01"), day("2024-01-12")), (day("2024-01-12"), day("2024-02-02"))]
    rows.where(~late).write.parquet(lake.path("buoy_measurements"))
    registry.refresh(lake, ["buoy_idw"], [*ranges, ranges[0]])
    rows.where(late).write.mode("append").parquet(lake.path("buoy_measurements"))
    registry.refresh(lake, ["buoy_idw"], ranges)
    return lake.table("buoy_idw").select(
        "cell", F.col("timestamp_tz").cast(NTZ).alias("hour"), *[f"idw_{c}" for c in CHANNELS]
    )


def _old_idw_sql(c: str) -> str:
    v = "old_wind_speed" if c == "wind_speed" else c
    return (
        f"round(coalesce(max(CASE WHEN dist = 0 THEN {v} END), sum(weight * {v}) / sum(weight)), 6)"
    )


@query(f"""
WITH {STATION_SQL}, {BUOY_SQL}, {buoy_idw_sql(6, False)}
SELECT cell, timestamp_tz AS hour, {", ".join(f"{_old_idw_sql(c)} AS idw_{c}" for c in CHANNELS)}
FROM buoy_hour JOIN buoy_near USING (station_id) GROUP BY cell, timestamp_tz
""")
def buoy_idw_all_weights(spark, sf_dir):
    """The same with the former rules: all weights count, and so does the unreadable wind speed."""
    return _buoy_idw(spark, sf_dir, compat=True).select(
        "cell", F.col("timestamp_tz").cast(NTZ).alias("hour"), *[f"idw_{c}" for c in CHANNELS]
    )


TAGS_SQL = f"""
{STATION_SQL}, {BUOY_SQL}, {BUOY_IDW_SQL}, {GAUGE_SQL}, {TIDE_IDW_SQL}, {WIND_SQL},
condition AS (
    SELECT b.cell, b.timestamp_tz, b.idw_wave_height AS f2, b.idw_average_wave_period AS f3,
           b.idw_measured_wave_direction AS f4,
           coalesce(round(t.idw_mm / 1000e0, 2), b.idw_tide) AS f5,
           round(coalesce(w.wind_speed_ms, b.idw_wind_speed), 2) AS f6,
           round(coalesce(w.wind_dir, b.idw_wind_direction), 2) AS f7
    FROM buoy_idw b
    LEFT JOIN tide_idw t ON t.cell = b.cell AND t.timestamp_tz = b.timestamp_tz
    LEFT JOIN wind w ON w.cell = b.cell AND w.timestamp_tz = b.timestamp_tz),
tag AS (
    SELECT * FROM condition WHERE f2 IS NOT NULL AND f3 IS NOT NULL AND f4 IS NOT NULL
       AND f5 IS NOT NULL AND f6 IS NOT NULL AND f7 IS NOT NULL)
"""


def tags(spark, sf_dir):
    return gold.condition_tags(
        written(_buoy_idw(spark, sf_dir), "buoy-idw"),
        silver.wind_measurements(wind_rows(spark, sf_dir)),
        _tide_idw(spark, sf_dir),
    )


@query(f"""
WITH {TAGS_SQL}
SELECT cell, timestamp_tz AS hour, CAST(cell AS DOUBLE) AS f1, f2, f3, f4, f5, f6, f7 FROM tag
""")
def condition_tags(spark, sf_dir):
    """The seven-element vector of every cell and hour with all features known."""
    return tags(spark, sf_dir).select(
        "cell",
        F.col("timestamp_tz").cast(NTZ).alias("hour"),
        *[F.get("tag", i).alias(f"f{i + 1}") for i in range(7)],
    )


PHOTO_SQL = f"""
{TAGS_SQL},
m AS (
    SELECT event_id, cell, hour FROM (
        SELECT p.event_id, t.cell, t.timestamp_tz AS hour,
               row_number() OVER (PARTITION BY p.event_id
                   ORDER BY abs(epoch_us(p.ts) - epoch_us(t.timestamp_tz)), t.timestamp_tz) AS rn
        FROM (SELECT event_id, ts, {cell_sql(LON_SQL, LAT_SQL)} AS cell FROM events) p
        JOIN tag t ON t.cell = p.cell
                  AND t.timestamp_tz BETWEEN p.ts - INTERVAL 30 MINUTE AND p.ts + INTERVAL 30 MINUTE)
    WHERE rn = 1)
"""


def _photo_search(spark, sf_dir):
    """Events as photos, searched in a stored index of the tags."""
    user = F.col("user_id")
    index = VectorIndex(work_path(spark, "tag-index"), "tag")
    named = tags(spark, sf_dir).withColumn("timestamp_tz", F.col("timestamp_tz").cast(NTZ))
    build_index(named, index, ["cell", "timestamp_tz"])
    cell = grid.cell_of(station_lon(user), station_lat(user)).alias("cell")
    photos = table(spark, sf_dir, "events").select("event_id", cell, "ts")
    return photo_search(index, photos, "event_id", "ts", "timestamp_tz", MATCH_WINDOW_MINUTES, digits=6)


@query(f"WITH {PHOTO_SQL} SELECT event_id, cell, hour AS matched_hour FROM m")
def photo_hours(spark, sf_dir):
    """The tag hour nearest to each photo in its cell."""
    matched, _ = _photo_search(spark, sf_dir)
    return matched.withColumnRenamed("matched_ts", "matched_hour")


@query(f"""
WITH {PHOTO_SQL}
SELECT q.cell, q.timestamp_tz AS matched_hour, s.cell AS similar_cell, s.timestamp_tz AS similar_hour,
       round(sqrt({" + ".join(f"(s.f{i} - q.f{i}) * (s.f{i} - q.f{i})" for i in range(2, 8))}), 6) AS l2_dist
FROM (SELECT DISTINCT t.* FROM tag t JOIN m ON m.cell = t.cell AND m.hour = t.timestamp_tz) q
JOIN tag s ON abs(s.f4 - q.f4) < 10 AND abs(s.f7 - q.f7) < 10
WHERE sqrt({" + ".join(f"(s.f{i} - q.f{i}) * (s.f{i} - q.f{i})" for i in range(2, 8))}) < 10e0
""")
def similar_condition_hours(spark, sf_dir):
    """The hours like those in which photos were taken, each searched once."""
    _, found = _photo_search(spark, sf_dir)
    return found.withColumnsRenamed({"matched_ts": "matched_hour", "similar_ts": "similar_hour"})


@query(f"""
SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 6) AS l2_dist
FROM embeddings
WHERE list_distance(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)) < 1.3e0
""")
def vector_search(spark, sf_dir):
    """Vectors within a radius of one query vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    wanted = vectors.where("vec_id = 0").select("embedding")
    found = search(vectors, "embedding", wanted, 1.3, digits=6)
    return found.select("vec_id", "l2_dist")


VECTOR_PARTS = [(1, 12), (1, 15), (1, 360), (1, 5), (1, 40), (7, 360)]
"""(factor, modulus) of each element: heights and speeds span little, the two directions a circle."""


def hour_vectors(spark, sf_dir):
    """A tag-like vector per station cell and hour, its elements derived from the largest reading."""
    user = F.col("user_id")
    largest = (
        table(spark, sf_dir, "events")
        .groupBy(
            grid.cell_of(station_lon(user), station_lat(user)).alias("cell"),
            truncate("HOUR", F.col("ts")).alias("hour"),
        )
        .agg(cents(F.max("value")).alias("n"))
    )
    elements = [(F.col("n") * f % m).cast("double") for f, m in VECTOR_PARTS]
    return largest.select("cell", "hour", F.array(F.col("cell").cast("double"), *elements).alias("tag"))


VECTOR_SQL = f"""
v AS (
    SELECT cell, hour, {", ".join(f"CAST(n * {f} % {m} AS DOUBLE) AS e{i}" for i, (f, m) in enumerate(VECTOR_PARTS, 2))}
    FROM (SELECT {cell_sql(LON_SQL, LAT_SQL)} AS cell, date_trunc('hour', ts) AS hour,
                 CAST(floor(max(value) * 100) AS BIGINT) AS n FROM events GROUP BY 1, 2)),
m AS (
    SELECT event_id, cell, hour FROM (
        SELECT p.event_id, v.cell, v.hour,
               row_number() OVER (PARTITION BY p.event_id
                   ORDER BY abs(epoch_us(p.ts) - epoch_us(v.hour)), v.hour) AS rn
        FROM (SELECT event_id, ts, {cell_sql(LON_SQL, LAT_SQL)} AS cell FROM events WHERE event_type = 'purchase') p
        JOIN v ON v.cell = p.cell AND v.hour BETWEEN p.ts - INTERVAL 30 MINUTE AND p.ts + INTERVAL 30 MINUTE)
    WHERE rn = 1),
pair AS (
    SELECT q.cell AS q_cell, q.hour AS q_hour, s.cell AS s_cell, s.hour AS s_hour,
           sqrt({" + ".join(f"(s.e{i} - q.e{i}) * (s.e{i} - q.e{i})" for i in range(2, 8))}) AS d
    FROM (SELECT DISTINCT v.* FROM v JOIN m USING (cell, hour)) q JOIN v s
      ON abs(s.e4 - q.e4) < 10 AND abs(s.e7 - q.e7) < 10)
"""


@query(f"""
WITH {VECTOR_SQL}
SELECT m.event_id, m.hour AS matched_hour, p.s_cell AS similar_cell, p.s_hour AS similar_hour, round(p.d, 6) AS l2_dist
FROM m JOIN pair p ON p.q_cell = m.cell AND p.q_hour = m.hour WHERE p.d < 10e0
""")
def search_by_media(spark, sf_dir):
    """Purchases as photos: the nearest hour of their cell, then all hours like it."""
    user = F.col("user_id")
    media = (
        table(spark, sf_dir, "events")
        .where("event_type = 'purchase'")
        .select("event_id", "ts", station_lon(user).alias("lon"), station_lat(user).alias("lat"))
    )
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = written(hour_vectors(spark, sf_dir).repartition(files, "cell", "hour"), "hour-vectors")
    found = media_search(media, vectors, "event_id", "ts", "hour", "tag", digits=6)
    return found.select(
        "event_id",
        F.col("matched_ts").alias("matched_hour"),
        "similar_cell",
        F.col("similar_ts").alias("similar_hour"),
        F.col("l2_dist"),
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS station_id, CAST(k AS INTEGER) AS station_sk, c_name AS name,
       TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey % 300 + 1 AS INTEGER)) * (k - 1) AS start_time,
       CASE WHEN k = 1 THEN TIMESTAMP '2001-01-01' + to_days(CAST(c_custkey % 300 + 1 AS INTEGER)) END AS end_time,
       -160e0 + (c_custkey % 20) * 0.25e0 + (k - 1) AS lon, 18e0 + (c_custkey % 30) * 0.5e0 AS lat,
       CAST(floor((18e0 + (c_custkey % 30) * 0.5e0 + 90) * 2) * 720
            + floor((-160e0 + (c_custkey % 20) * 0.25e0 + (k - 1) + 180) * 2) AS BIGINT) AS cell,
       CASE WHEN k = 1 THEN 4.5e0 END AS elev
FROM customer, (SELECT unnest([1, 2]) AS k)
""")
def station_history(spark, sf_dir):
    """Station elements with nested moves, numbered by start."""
    n = F.col("c_custkey")
    lon = lambda k: (F.lit(-160.0) + (n % 20) * F.lit(0.25) + k).cast("string")
    lat = (F.lit(18.0) + (n % 30) * F.lit(0.5)).cast("string")
    move = F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (n % 300 + 1).cast("int")), "yyyy-MM-dd")
    xml = F.format_string(
        '<station id="%d" name="%s" owner="o" pgm="p" type="buoy">'
        '<history start="%s" stop="" lat="%s" lng="%s" elev="" met="y" hull="" anemom_height="5.0"/>'
        '<history start="2001-01-01" stop="%s" lat="%s" lng="%s" elev="4.5" met="n" hull="" anemom_height=""/>'
        "</station>",
        n, F.col("c_name"), move, lat, lon(1), move, lat, lon(0),
    )
    docs = table(spark, sf_dir, "customer").select(xml.alias("xml"))
    rows = dimensions.station_history(parse_station_xml(docs, "xml"))
    return rows.select(
        "station_id",
        "station_sk",
        "name",
        F.col("start_time").cast(NTZ).alias("start_time"),
        F.col("end_time").cast(NTZ).alias("end_time"),
        F.col("geometry.lon").alias("lon"),
        F.col("geometry.lat").alias("lat"),
        "cell",
        "elev",
    )


@query("""
SELECT printf('%03d', s_suppkey) AS uh_id, s_suppkey * 3 AS gloss_id, 'b' AS version,
       printf('%03d', s_suppkey) || 'b' AS station_id, s_name AS location,
       TIMESTAMP '1990-01-01' + to_days(CAST(s_suppkey % 1000 AS INTEGER)) AS start_time,
       CAST(floor((CAST(s_suppkey % 60 AS DOUBLE) + 90) * 2) * 720 + floor((-150e0 + 180) * 2) AS BIGINT) AS cell
FROM supplier
UNION ALL
SELECT 'h' || printf('%03d', c_custkey), NULL, 'fast', 'h' || printf('%03d', c_custkey) || 'fast', c_name,
       TIMESTAMP '1990-01-01' + to_days(CAST(c_custkey % 1000 AS INTEGER)),
       CAST(floor((CAST(c_custkey % 60 AS DOUBLE) + 90) * 2) * 720 + floor((-150e0 + 180) * 2) AS BIGINT)
FROM customer
""")
def tide_stations(spark, sf_dir):
    """Research and fast-delivery gauge lists in one shape."""

    def listed(name, key, label, gloss, version):
        n = F.col(key)
        day = F.date_add(F.lit("1990-01-01").cast("date"), (n % 1000).cast("int"))
        values = {
            "UH#": n.cast("string"),
            "GLOSS#": gloss,
            "Version": version,
            "Location": F.col(label),
            "Country": F.lit("x"),
            "Longitude": F.lit("-150.0"),
            "Latitude": (n % 60).cast("string"),
            "Start": F.date_format(day, "yyyy-MM-dd"),
            "End": F.lit(""),
        }
        return table(spark, sf_dir, name).select(*[v.alias(k) for k, v in values.items()])

    rows = dimensions.tide_stations(
        listed("supplier", "s_suppkey", "s_name", (F.col("s_suppkey") * 3).cast("string"), F.lit("b")),
        listed("customer", "c_custkey", "c_name", F.lit(""), F.lit(None).cast("string")),
    )
    return rows.select(
        "uh_id",
        "gloss_id",
        "version",
        "station_id",
        "location",
        F.col("start_time").cast(NTZ).alias("start_time"),
        "cell",
    )


KINDS = ("click", "view", "purchase", "signup", "error")


@query(f"""
WITH v AS (
    SELECT {cell_sql(LON_SQL, LAT_SQL)} AS cell, date_trunc('hour', ts) AS hour,
           {", ".join(f"coalesce(avg(value) FILTER (event_type = '{k}'), 0e0) AS {k}" for k in KINDS)},
           CAST(count(*) AS DOUBLE) AS n
    FROM events GROUP BY 1, 2),
m AS (
    SELECT event_id, cell, hour FROM (
        SELECT p.event_id, v.cell, v.hour,
               row_number() OVER (PARTITION BY p.event_id
                   ORDER BY abs(epoch_us(p.ts) - epoch_us(v.hour)), v.hour) AS rn
        FROM (SELECT event_id, ts, {cell_sql(LON_SQL, LAT_SQL)} AS cell FROM events WHERE event_type = 'purchase') p
        JOIN v ON v.cell = p.cell AND v.hour BETWEEN p.ts - INTERVAL 30 MINUTE AND p.ts + INTERVAL 30 MINUTE)
    WHERE rn = 1),
pair AS (
    SELECT q.cell AS q_cell, q.hour AS q_hour, s.cell AS s_cell, s.hour AS s_hour,
           sqrt({" + ".join(f"(s.{k} - q.{k}) * (s.{k} - q.{k})" for k in (*KINDS, "n"))}) AS d
    FROM (SELECT DISTINCT v.* FROM v JOIN m USING (cell, hour)) q JOIN v s
      ON abs(s.click - q.click) < 10 AND abs(s.view - q.view) < 10)
SELECT m.event_id, m.hour AS matched_hour, p.s_cell AS similar_cell, p.s_hour AS similar_hour, round(p.d, 6) AS l2_dist
FROM m JOIN pair p ON p.q_cell = m.cell AND p.q_hour = m.hour WHERE p.d < 10e0
""")
def search_by_channel_means(spark, sf_dir):
    """The same search over channel means: most are 0, so a few bands hold most of the hours."""
    user = F.col("user_id")
    place = [station_lon(user).alias("lon"), station_lat(user).alias("lat")]
    events = table(spark, sf_dir, "events")
    media = events.where("event_type = 'purchase'").select("event_id", "ts", *place)
    hour = truncate("HOUR", F.col("ts")).alias("hour")
    mean = lambda k: F.avg(F.when(F.col("event_type") == k, F.col("value")))
    means = events.groupBy(grid.cell_of(station_lon(user), station_lat(user)).alias("cell"), hour).agg(
        *[F.coalesce(mean(k), F.lit(0.0)).alias(k) for k in KINDS],
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    tag = F.array(F.col("cell").cast("double"), *[F.col(k) for k in KINDS], F.col("n"))
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    vectors = means.select("cell", "hour", tag.alias("tag")).repartition(files, "cell", "hour")
    found = media_search(
        media, written(vectors, "channel-means"), "event_id", "ts", "hour", "tag",
        cut=(2, 3, 4, 5), digits=6,
    )
    return found.select(
        "event_id",
        F.col("matched_ts").alias("matched_hour"),
        "similar_cell",
        F.col("similar_ts").alias("similar_hour"),
        "l2_dist",
    )
