"""Aggregation, interpolation, numbering, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions.moments import micros, truncate
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators import audit, interpolate, ranking, spatial
from shoregrid.queries import query
from shoregrid.queries.inputs import (
    HOUR_SQL,
    LAT_SQL,
    LON_SQL,
    STATION_SQL,
    cell_sql,
    idw_sql,
    station_cells,
    station_lat,
    station_lon,
    stations,
    table,
)
from shoregrid.functions.grid import cell_of
from shoregrid.session import work_path


@query("""
SELECT user_id, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS mean_value,
       arg_max(value, event_id) AS last_value, count(*) AS n
FROM events GROUP BY ALL
""")
def cell_hour_mean(spark, sf_dir):
    """Means per place and hour, with a value carried along by a fixed rule."""
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id", truncate("HOUR", F.col("ts")).alias("hour"))
        .agg(
            round_half_away(F.avg("value"), 6).alias("mean_value"),
            F.max_by("value", "event_id").alias("last_value"),
            F.count(F.lit(1)).alias("n"),
        )
    )


CHANNELS = ("click", "view", "purchase", "signup", "error")


def channel_rows(spark, sf_dir):
    """Events as station readings, one channel per event type."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        *[F.when(F.col("event_type") == c, F.col("value")).alias(c) for c in CHANNELS],
    )


CHANNEL_MEANS_SQL = f"""
hourly AS (
    SELECT user_id,
           CASE WHEN minute(time_bucket(INTERVAL 30 MINUTE, ts)) = 30
                THEN time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE
                ELSE time_bucket(INTERVAL 30 MINUTE, ts) END AS ts,
           {", ".join(f"avg(CASE WHEN event_type = '{c}' AND value <> 99e0 THEN value END) AS {c}"
                      for c in CHANNELS)}
    FROM events GROUP BY 1, 2)
"""


@query(f"""
WITH {CHANNEL_MEANS_SQL}
SELECT user_id, ts, {", ".join(f"round({c}, 6) AS {c}" for c in CHANNELS)} FROM hourly
""")
def hourly_mean(spark, sf_dir):
    means = interpolate.hourly_mean(
        channel_rows(spark, sf_dir), ["user_id"], "ts", {c: (99.0,) for c in CHANNELS}
    )
    return means.select(
        "user_id", "ts", *[round_half_away(F.col(c), 6).alias(c) for c in CHANNELS]
    )


def interpolated_values(spark, sf_dir):
    near = spatial.disk_join(station_cells(spark, sf_dir), stations(spark, sf_dir), "user_id")
    hourly = interpolate.hourly_mean(
        table(spark, sf_dir, "events"), ["user_id"], "ts", {"value": (99.0,)}
    )
    return interpolate.idw(near, hourly, "user_id", "ts", ["value"], 6, unique=True)


@query(f"""
WITH {STATION_SQL},
hourly AS (
    SELECT user_id, {HOUR_SQL} AS ts, avg(CASE WHEN value <> 99e0 THEN value END) AS value
    FROM events GROUP BY 1, 2)
SELECT cell, ts, {idw_sql("value", 6)} AS idw_value
FROM hourly JOIN near USING (user_id) GROUP BY cell, ts
""")
def idw_hourly(spark, sf_dir):
    """Hourly means interpolated onto the cells around the stations."""
    return interpolated_values(spark, sf_dir)


@query(f"""
WITH {STATION_SQL}, {CHANNEL_MEANS_SQL}
SELECT cell, ts, {", ".join(f"{idw_sql(c, 6)} AS idw_{c}" for c in CHANNELS)}
FROM hourly JOIN near USING (user_id) GROUP BY cell, ts
""")
def idw_channels(spark, sf_dir):
    """Five sparse channels at once; each is weighted over the readings it has."""
    near = spatial.disk_join(station_cells(spark, sf_dir), stations(spark, sf_dir), "user_id")
    hourly = interpolate.hourly_mean(
        channel_rows(spark, sf_dir), ["user_id"], "ts", {c: (99.0,) for c in CHANNELS}
    )
    return interpolate.idw(near, hourly, "user_id", "ts", list(CHANNELS), 6, unique=True)


@query(f"""
WITH {STATION_SQL},
reading AS (SELECT user_id, date_trunc('day', ts) AS ts, value FROM events)
SELECT cell, ts, {idw_sql("value", 6)} AS idw_value
FROM reading JOIN near USING (user_id) GROUP BY cell, ts
""")
def idw_repeated_readings(spark, sf_dir):
    """Many readings of one station and time: summed up before they are handed to the cells."""
    near = spatial.disk_join(station_cells(spark, sf_dir), stations(spark, sf_dir), "user_id")
    readings = table(spark, sf_dir, "events").select(
        "user_id", truncate("DAY", F.col("ts")).alias("ts"), "value"
    )
    return interpolate.idw(near, readings, "user_id", "ts", ["value"], 6)


@query("""
SELECT user_id, date_trunc('hour', ts) AS hour, count(*) AS n FROM events
GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "user_id", truncate("HOUR", F.col("ts")).alias("hour")
    )
    return audit.duplicates(rows, ["user_id", "hour"])


@query("""
SELECT o_custkey, (rn - 1) // 10 AS chunk, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS items
FROM (SELECT o_custkey, o_orderkey,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
GROUP BY 1, 2
""")
def sorted_lists(spark, sf_dir):
    """Values of a key as sorted lists of bounded length."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    lists = ranking.chunked_lists(orders, ["o_custkey"], F.col("o_orderkey"), "o_orderkey", 10)
    return lists.select("o_custkey", "chunk", F.array_join("values", ",").alias("items"))


@query(f"SELECT DISTINCT {cell_sql(LON_SQL, LAT_SQL)} AS cell FROM events")
def dissolved_cells(spark, sf_dir):
    user = F.col("user_id")
    cells = table(spark, sf_dir, "events").select(
        cell_of(station_lon(user), station_lat(user)).alias("cell")
    )
    return spatial.dissolve(cells)


@query("""
SELECT o_orderkey, o_custkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS station_sk
FROM orders
""")
def surrogate_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    placed = ranking.numbered(
        orders, ["o_custkey"], micros(F.col("o_orderdate")), "o_orderkey", "station_sk"
    )
    return placed.drop("o_orderdate")


@query("""
SELECT event_id, CAST(ntile(40) OVER (ORDER BY event_id) AS INTEGER) AS tile FROM events
""")
def even_split(spark, sf_dir):
    """The whole table in 40 consecutive parts, numbered without gathering it in one task."""
    events = table(spark, sf_dir, "events").select("event_id")
    return ranking.even_split(events, 40, F.col("event_id"), "event_id")


@query("""
SELECT (rn - 1) // 5 AS batch, string_agg(CAST(page_id AS VARCHAR), ',' ORDER BY page_id) AS items
FROM (SELECT page_id, row_number() OVER (ORDER BY page_id) AS rn FROM pages) GROUP BY 1
""")
def backfill_batches(spark, sf_dir):
    """Consecutive batches of five."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    made = ranking.batches(pages, 5, F.col("page_id"), "page_id", ["page_id"])
    return made.select("batch", F.array_join(F.col("items.page_id"), ",").alias("items"))


@query("""
SELECT user_id, min(ts) AS ts, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id
""")
def first_rows(spark, sf_dir):
    """The first event of each user, of all events: a least row with map-side combine, no sort and no limit."""
    first = F.min(F.struct("ts", "event_id")).alias("first")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(first).select("user_id", "first.*")


@query("SELECT page_id, url FROM pages WHERE page_id > (SELECT min(page_id) FROM pages)")
def without_header_row(spark, sf_dir):
    """Everything but the first row by key."""
    return ranking.skip_first(table(spark, sf_dir, "pages").select("page_id", "url"), "page_id")


@query("SELECT user_id, ts, value FROM events")
def clustered_rows(spark, sf_dir):
    """Rows laid out by place and time."""
    return ranking.clustered(table(spark, sf_dir, "events").select("user_id", "ts", "value"), "user_id", "ts")


@query(f"""
SELECT count(*) AS n, CAST(sum(CAST(floor(value * 100) AS BIGINT)) FILTER (
           {cell_sql(LON_SQL, LAT_SQL)} = (SELECT min({cell_sql(LON_SQL, LAT_SQL)}) FROM events)
           AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11') AS BIGINT) AS total, true AS few_files
FROM events
""")
def clustered_files(spark, sf_dir):
    """Rows laid out by cell and time at once: one cell's day touches no more files than both cuts together allow."""
    user = F.col("user_id")
    cell = cell_of(station_lon(user), station_lat(user)).alias("cell")
    rows = table(spark, sf_dir, "events").select(cell, "ts", "value")
    path, parts = work_path(spark, "clustered"), 64
    ranking.clustered_by_all(rows, ["cell", "ts"], parts=parts).write.parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    first = stored.agg(F.min("cell")).scalar()
    day = F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-10 23:59:59.999999").cast("timestamp_ntz")
    touched = ranking.files_touched(stored, {"cell": (first, first), "ts": day})
    # 64 files are 8 by 8 in cells and times: a cell and a day lie in one column and one row, two at an edge
    inside = (F.col("cell") == first) & F.col("ts").between(*day)
    cents = F.floor(F.col("value") * 100).cast("long")
    sums = stored.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(inside, cents)).alias("total"))
    return sums.withColumn("few_files", touched.select((F.col("touched") <= 16) & (F.col("files") > 32)).scalar())


@query("SELECT c_name AS name FROM customer UNION ALL SELECT s_name FROM supplier")
def union_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


@query("""
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_by_name(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key")
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)
