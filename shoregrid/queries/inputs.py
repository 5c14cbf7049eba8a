"""Roles the given tables play, and the same derivations as SQL fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.functions import grid, text


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with its declared schema: no job to infer it from file footers."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def station_lon(user: Column) -> Column:
    return F.lit(-160.0) + (user % 20) * F.lit(0.35)


def station_lat(user: Column) -> Column:
    return F.lit(18.0) + (F.floor(user / 20) % 20) * F.lit(0.3)


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event users as stations with a place derived from their number."""
    user = F.col("user_id")
    placed = (
        table(spark, sf_dir, "events")
        .select("user_id")
        .distinct()
        .select("user_id", station_lon(user).alias("lon"), station_lat(user).alias("lat"))
    )
    return placed.withColumn("station_cell", grid.cell_of(F.col("lon"), F.col("lat")))


def station_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that hold stations, and their eastern neighbours, as the cells to interpolate to."""
    cell = F.col("station_cell")
    return (
        stations(spark, sf_dir)
        .select(F.explode(F.array(cell, cell + 1)).alias("cell"))
        .distinct()
    )


def cell_sql(lon: str, lat: str) -> str:
    return f"CAST(floor(({lat} + 90) * 2) * 720 + floor(({lon} + 180) * 2) AS BIGINT)"


def centre_lon_sql(cell: str) -> str:
    return f"(({cell} % 720 + 0.5e0) / 2e0 - 180e0)"


def centre_lat_sql(cell: str) -> str:
    return f"(({cell} // 720 + 0.5e0) / 2e0 - 90e0)"


def distance_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (
        f"12742017.5428e0 * asin(least(1e0, sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * "
        f"pow(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


LON_SQL = "(-160e0 + (user_id % 20) * 0.35e0)"
LAT_SQL = "(18e0 + ((user_id // 20) % 20) * 0.3e0)"
HOUR_SQL = "date_trunc('hour', ts + INTERVAL 30 MINUTE)"

STATION_SQL = f"""
station AS (
    SELECT user_id, {LON_SQL} AS lon, {LAT_SQL} AS lat, {cell_sql(LON_SQL, LAT_SQL)} AS station_cell
    FROM (SELECT DISTINCT user_id FROM events)),
wanted AS (
    SELECT DISTINCT unnest([station_cell, station_cell + 1]) AS cell FROM station),
near AS (
    SELECT cell, user_id, dist, CASE WHEN dist <> 0 THEN 1e0 / (dist * dist) END AS weight FROM (
        SELECT w.cell, s.user_id,
               {distance_sql("s.lon", "s.lat", centre_lon_sql("w.cell"), centre_lat_sql("w.cell"))} AS dist
        FROM wanted w JOIN station s
          ON abs(w.cell // 720 - s.station_cell // 720) <= 2
         AND abs(w.cell % 720 - s.station_cell % 720) <= 2))
"""


def padded_sql(number: str, width: int = 5) -> str:
    text_sql = f"CAST({number} AS VARCHAR)"
    return f"lpad({text_sql}, CAST(greatest({width}, length({text_sql})) AS INTEGER), '0')"


def cents(value: Column) -> Column:
    return F.floor(value * 100).cast("long")


CENTS_SQL = "CAST(floor(value * 100) AS BIGINT)"


TOKENS = [
    # modulus, one decimal?, every k-th value is unreadable or missing, written as
    (360, False, 17, "999"),
    (40, True, 19, "MM"),
    (50, True, 0, ""),
    (12, True, 23, "99.00"),
    (20, True, 0, ""),
    (15, True, 29, "99.00"),
    (360, False, 13, "MM"),
    (60, True, 0, ""),
    (30, True, 0, ""),
    (25, True, 0, ""),
    (1, True, 1, "MM"),
    (1, True, 1, "99.0"),
    (5, True, 3, "99.00"),
]


def one_per_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest reading of each station and time as written (minutes for even stations, hours for odd ones)."""
    written_at = F.when(F.col("user_id") % 2 == 0, F.date_trunc("MINUTE", "ts")).otherwise(F.date_trunc("HOUR", "ts"))
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", written_at.cast("timestamp_ntz").alias("ts"))
        .agg(F.max("value").alias("value"), F.min("event_id").alias("event_id"))
    )


ONE_PER_TIME_SQL = """
reading AS (
    SELECT user_id, date_trunc(CASE WHEN user_id % 2 = 0 THEN 'minute' ELSE 'hour' END, ts) AS ts,
           max(value) AS value
    FROM events GROUP BY ALL)
"""


def buoy_text(spark: SparkSession, sf_dir: str, readings: DataFrame | None = None) -> DataFrame:
    """Events as raw buoy text: even stations write files with a minute column, odd ones without.

    Raw text arrives as many files; the rows are spread evenly to stand in for that, as a small
    table may sit in one file that a single task reads.
    """
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n, even = F.col("n"), F.col("user_id") % 2 == 0
    recipe = F.array(
        *[
            F.struct(
                F.lit(m).alias("m"), F.lit(d).alias("d"), F.lit(k).alias("k"), F.lit(t).alias("t")
            )
            for m, d, k, t in TOKENS
        ]
    )

    def token(r: Column) -> Column:
        whole = (n % r["m"]).cast("string")
        shown = F.when(r["d"], F.concat(whole, F.lit("."), (n % 10).cast("string"))).otherwise(whole)
        return F.when((r["k"] > 0) & (F.try_mod(n, r["k"].cast("long")) == 0), r["t"]).otherwise(shown)

    time = F.when(even, F.date_format("ts", "yyyy MM dd HH mm")).otherwise(
        F.date_format("ts", "yyyy MM dd HH")
    )
    name = F.concat(
        F.lit("archive/stdmet/"),
        text.zero_pad(F.col("user_id"), 5),
        F.when(even, F.lit("h2024.txt.gz")).otherwise(F.lit("h2004.txt.gz")),
    )
    events = (
        (readings or table(spark, sf_dir, "events"))
        .select("event_id", "user_id", "ts", cents(F.col("value")).alias("n"))
        .repartition(files, "event_id")
    )
    line = F.concat_ws("  ", time, F.transform(recipe, token))
    return events.select(name.alias("filename"), line.alias("value"))


def station_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records per station: it moves by 0.1 degrees in the middle of the month."""
    move = F.lit("2024-01-15 00:00:00").cast("timestamp")
    base = stations(spark, sf_dir).select(
        text.zero_pad(F.col("user_id"), 5).alias("station_id"), "lon", "lat"
    )
    second = F.col("station_sk") == 2
    lon = F.when(second, F.col("lon") + 0.1).otherwise(F.col("lon"))
    return base.withColumn("station_sk", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        "station_id",
        "station_sk",
        grid.point(lon, F.col("lat")).alias("geometry"),
        grid.cell_of(lon, F.col("lat")).alias("cell"),
        F.when(second, move).otherwise(F.lit("2023-01-01").cast("timestamp")).alias("start_time"),
        F.when(~second, move - F.expr("INTERVAL '0.000001' SECOND")).alias("end_time"),
    )


def _tenth_sql(n: str) -> str:
    return f"CAST(({n}) || '.' || (n % 10) AS DOUBLE)"


BUOY_SQL = f"""
sighting AS (
    SELECT *, {padded_sql("user_id")} AS station_name,
           {CENTS_SQL} AS n,
           date_trunc(CASE WHEN user_id % 2 = 0 THEN 'minute' ELSE 'hour' END, ts) AS seen
    FROM events),
measured AS (
    SELECT station_name AS station_id, seen AS timestamp_tz,
           CASE WHEN seen < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS station_sk,
           CASE WHEN seen < TIMESTAMP '2024-01-15' THEN {LON_SQL} ELSE {LON_SQL} + 0.1e0 END AS lon,
           {LAT_SQL} AS lat,
           CASE WHEN n % 17 = 0 THEN 999 ELSE n % 360 END AS wind_direction,
           CASE WHEN n % 19 = 0 THEN 999.9e0 ELSE {_tenth_sql("n % 40")} END AS wind_speed,
           {_tenth_sql("n % 50")} AS wind_gust,
           CASE WHEN n % 23 = 0 THEN 99e0 ELSE {_tenth_sql("n % 12")} END AS wave_height,
           {_tenth_sql("n % 20")} AS dominant_wave_period,
           CASE WHEN n % 29 = 0 THEN 99e0 ELSE {_tenth_sql("n % 15")} END AS average_wave_period,
           CASE WHEN n % 13 = 0 THEN 999 ELSE n % 360 END AS measured_wave_direction,
           {_tenth_sql("n % 60")} AS sea_level_pressure,
           {_tenth_sql("n % 30")} AS air_temp,
           {_tenth_sql("n % 25")} AS water_temp,
           999.9e0 AS dew_point_temp,
           99e0 AS visibility,
           CASE WHEN n % 3 = 0 THEN 99e0 ELSE {_tenth_sql("n % 5")} END AS tide
    FROM sighting)
"""


def gauge_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly gauge rows out of files named by a padded number and a version letter."""
    events = table(spark, sf_dir, "events")
    ts = F.col("ts")
    name = F.concat(
        F.lit("hourly/h"), text.zero_pad(F.col("user_id") % 1000, 3), F.lit("a.csv")
    )
    return events.select(
        name.alias("filename"),
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        (F.floor(F.col("value") * 40) - 2800).alias("reading_mm"),
    )


def gauge_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gauges share the stations' places; a thousand numbers exist."""
    number = F.col("user_id") % 1000
    base = stations(spark, sf_dir).select(number.alias("user_id")).distinct()
    lon, lat = station_lon(F.col("user_id")), station_lat(F.col("user_id"))
    return base.select(
        F.concat(text.zero_pad(F.col("user_id"), 3), F.lit("a")).alias("station_id"),
        grid.point(lon, lat).alias("geometry"),
        grid.cell_of(lon, lat).alias("cell"),
    )


GAUGE_SQL = f"""
gauge_row AS (
    SELECT user_id % 1000 AS user_id, date_trunc('hour', ts) AS timestamp_tz,
           CAST(floor(value * 40) AS BIGINT) - 2800 AS reading_mm
    FROM events),
gauge AS (
    SELECT user_id, {LON_SQL} AS lon, {LAT_SQL} AS lat, {cell_sql(LON_SQL, LAT_SQL)} AS station_cell
    FROM (SELECT DISTINCT user_id % 1000 AS user_id FROM events)),
gauge_near AS (
    SELECT cell, user_id, dist, CASE WHEN dist <> 0 THEN 1e0 / (dist * dist) END AS weight FROM (
        SELECT w.cell, s.user_id,
               {distance_sql("s.lon", "s.lat", centre_lon_sql("w.cell"), centre_lat_sql("w.cell"))} AS dist
        FROM wanted w JOIN gauge s
          ON abs(w.cell // 720 - s.station_cell // 720) <= 2
         AND abs(w.cell % 720 - s.station_cell % 720) <= 2))
"""


def wind_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the two wind components at the stations' places: even numbers eastward, odd ones northward."""
    user = F.col("user_id")
    lon, lat = station_lon(user), station_lat(user)
    label = F.when(F.col("event_id") % 2 == 0, "VAR_10U").otherwise("VAR_10V")
    hour = F.date_trunc("HOUR", "ts")
    return table(spark, sf_dir, "events").select(
        ((F.col("value") - 60.0) / 10.0).alias("wind_dim_val"),
        label.alias("wind_dim"),
        lon.alias("longitude"),
        lat.alias("latitude"),
        hour.alias("utc_date"),
        grid.cell_of(lon, lat).alias("cell"),
    )


WIND_UV_SQL = """
wind_uv AS (
    SELECT cell, timestamp_tz, avg(part) FILTER (eastward) AS u, avg(part) FILTER (NOT eastward) AS v,
           max(struct_pack(lon := lon, lat := lat)) FILTER (eastward) AS place
    FROM wind_part GROUP BY cell, timestamp_tz),
wind AS (
    SELECT cell, timestamp_tz, place.lon AS lon, place.lat AS lat, sqrt(u * u + v * v) AS wind_speed_ms,
           (degrees(atan2(-u, -v)) + 360e0) % 360e0 AS wind_dir
    FROM wind_uv WHERE u IS NOT NULL AND v IS NOT NULL)
"""

WIND_SQL = f"""
wind_part AS (
    SELECT {cell_sql(LON_SQL, LAT_SQL)} AS cell, date_trunc('hour', ts) AS timestamp_tz, event_id % 2 = 0 AS eastward,
           (value - 60e0) / 10e0 AS part, {LON_SQL} AS lon, {LAT_SQL} AS lat
    FROM events), {WIND_UV_SQL}
"""


def idw_sql(value: str, digits: int) -> str:
    return (
        f"round(coalesce(max(CASE WHEN dist = 0 THEN {value} END), "
        f"sum(weight * {value}) / sum(CASE WHEN {value} IS NOT NULL THEN weight END)), {digits})"
    )
