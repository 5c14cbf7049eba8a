"""Sources and sinks: write what the given tables hold in a source's format, read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions import text
from shoregrid.operators.sized import dealt, join_dimension
from shoregrid.queries import query
from shoregrid.queries.inputs import padded_sql, table
from shoregrid.session import work_path
from shoregrid.sinks import tables
from shoregrid.sources import documents, files, gridded


PAGES_A_TASK = 10_000


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def dimension_scan(spark, sf_dir):
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("""
SELECT TIMESTAMP '2000-01-01' + to_hours(CAST(page_id AS BIGINT)) AS indexed,
       split_part(url, '/', 3) AS station_id, url AS archive_url,
       'landing/' || CAST(page_id AS VARCHAR) AS s3_url
FROM pages
""")
def archive_index(spark, sf_dir):
    """An index of stored pages written as CSV with header and read with its declared schema."""
    hours = F.make_dt_interval(F.lit(0), F.col("page_id").cast("int"))
    index = table(spark, sf_dir, "pages").select(
        (F.lit("2000-01-01 00:00:00").cast("timestamp") + hours).alias("timestamp_tz"),
        text.part(F.col("url"), "/", 3).alias("station_id"),
        F.col("url").alias("archive_url"),
        F.concat(F.lit("landing/"), F.col("page_id").cast("string")).alias("s3_url"),
    )
    path = work_path(spark, "archive-index")
    tables.write_csv(index, path)
    return files.read_archive_index(spark, path).select(
        F.col("timestamp_tz").cast("timestamp_ntz").alias("indexed"),
        "station_id",
        "archive_url",
        "s3_url",
    )


TOKEN_SQL = "str_split(regexp_replace({0}, '[ \\t\\n\\f\\r]+', ',', 'g'), ',')"


@query(f"""
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_fields, md5(array_to_string(tokens, '|')) AS digest
FROM (SELECT doc_id, {TOKEN_SQL.format("text")} AS tokens FROM documents)
""")
def document_fields(spark, sf_dir):
    """Whole document texts cut into blank-separated fields."""
    line = text.fields(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(line).alias("n_fields"),
        F.md5(F.array_join(line, "|")).alias("digest"),
    )


@query("""
SELECT 'event' AS kind, CAST(event_id AS VARCHAR) AS id, 4 AS n_fields,
       event_type AS label, strftime(ts, '%Y%m%d') AS day
FROM events
""")
def observation_files(spark, sf_dir):
    """Text files with comments and leading blanks, read as observation lines."""
    lines = table(spark, sf_dir, "events").select(
        F.concat(
            F.date_format("ts", "yyyyMMdd"),
            F.lit("   "),
            F.col("event_id").cast("string"),
            F.lit("\t"),
            F.col("event_type"),
            F.lit("  end"),
        ).alias("value")
    )
    comments = lines.select(F.concat(F.lit("#YYYYMMDD "), F.md5("value")).alias("value"))
    path = work_path(spark, "observations")
    lines.unionByName(comments).write.text(path)
    line = F.col("line")
    return files.read_observation_text(spark, path).select(
        F.lit("event").alias("kind"),
        text.field_at(line, 2).alias("id"),
        F.size(line).alias("n_fields"),
        text.field_at(line, 3).alias("label"),
        text.field_at(line, 1).alias("day"),
    )


@query("""
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
       CAST(floor(value * 100) AS BIGINT) AS reading_mm
FROM events
""")
def positional_csv(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"), F.floor(F.col("value") * 100)
    )
    path = work_path(spark, "positional")
    rows.write.csv(path, header=False)
    return files.read_positional_csv(spark, path).drop("filename")


@query("SELECT event_id, user_id, value FROM events WHERE event_type = 'view'")
def partitioned_scan(spark, sf_dir):
    """A sorted, folder-partitioned copy, of which one partition is read."""
    path = work_path(spark, "partitioned")
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "value", "event_type"
    )
    tables.append_partitioned(events, path, ["event_type"], ["user_id", "ts"])
    schema = "event_id long, user_id long, ts timestamp_ntz, value double, event_type string"
    return files.read_partitioned(spark, path, schema, F.col("event_type") == "view").select(
        "event_id", "user_id", "value"
    )


@query("""
SELECT DISTINCT event_type, CAST(date_trunc('day', ts) AS DATE) AS day FROM events
""")
def landed_folders(spark, sf_dir):
    """Partition values out of a listing of what has landed."""
    path = work_path(spark, "landed")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("day")
    )
    tables.append_partitioned(events, path, ["event_type", "day"], ["event_id"])
    found = files.landed_partitions(
        files.list_files(spark, path, "*.parquet"), ["event_type", "day"]
    )
    return found.select("event_type", F.col("day").cast("date").alias("day"))


@query("SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS href FROM pages")
def listing_links(spark, sf_dir):
    return documents.extract_links(table(spark, sf_dir, "pages").select("page_id", "html"), "html")


@query("""
SELECT p_partkey, CAST(1 AS BIGINT) AS row_no, p_name AS "Name", p_brand AS "Brand",
       CAST(p_size AS VARCHAR) AS "Size" FROM part
UNION ALL
SELECT p_partkey, 2, upper(p_name), p_type, 'n/a & more' FROM part
""")
def html_tables(spark, sf_dir):
    """Listing pages with two tables, the second one taken by header."""
    page = """<html><body><table><tr><th>Other</th></tr><tr><td>x</td></tr></table>
<TABLE class="list"><tr><th>Name</th><th>Brand</th><th>Size</th></tr>
<tr><td><a href="%s">%s</a></td><td>%s</td><td>%d</td></tr>
<tr><td>%s<td>%s<td>n/a &amp;  more</tr></TABLE></body></html>"""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_type")
    pages = dealt(parts, PAGES_A_TASK).select(
        "p_partkey",
        F.format_string(
            page, "p_name", "p_name", "p_brand", "p_size", F.upper("p_name"), F.col("p_type")
        ).alias("html"),
    )
    return documents.extract_table(pages, "p_partkey", "html", ["Name", "Brand", "Size"], n=2)


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, CAST(s_nationkey AS DOUBLE) AS lon,
       CAST(s_suppkey % 90 AS DOUBLE) + 0.5e0 AS lat, CAST(3 AS INTEGER) AS n_parameters,
       TIMESTAMP '2001-02-03 04:05' AS time_start,
       TIMESTAMP '2001-02-03 04:05' + to_days(CAST(s_suppkey % 1000 AS INTEGER)) AS time_end
FROM supplier
""")
def inventory_documents(spark, sf_dir):
    """Nested inventory documents: coordinates and the range of one parameter out of several."""
    from shoregrid.plans.inventory import water_level_inventory

    first = F.lit("2001-02-03 04:05:00").cast("timestamp_ntz")
    last = first + F.make_dt_interval((F.col("s_suppkey") % 1000).cast("int"))
    xml = F.format_string(
        '<x:Envelope xmlns:x="urn:x"><x:Body><DataInventory><station ID="%d">'
        "<metadata><location><lat>%d.5</lat><long>%d</long></location></metadata>"
        '<parameter name="Wind" first="1999-01-01 00:00" last="2000-01-01 00:00"/>'
        '<parameter name="Verified 6-Minute Water Level" first="2001-02-03 04:05" last="%s"/>'
        '<parameter name="Air" first="1990-01-01 00:00" last="1991-01-01 00:00"/>'
        "</station></DataInventory></x:Body></x:Envelope>",
        F.col("s_suppkey"),
        F.col("s_suppkey") % 90,
        F.col("s_nationkey"),
        F.date_format(last, "yyyy-MM-dd HH:mm"),
    )
    parsed = documents.parse_inventory(
        table(spark, sf_dir, "supplier").select(xml.alias("xml")), "xml"
    )
    counted = parsed.select("station_id", F.size("parameters").alias("n_parameters"))
    ranges = water_level_inventory(parsed)
    return join_dimension(ranges, counted, ["station_id"]).select(
        "station_id",
        F.col("geom.lon").alias("lon"),
        F.col("geom.lat").alias("lat"),
        "n_parameters",
        F.col("time_start").cast("timestamp_ntz").alias("time_start"),
        F.col("time_end").cast("timestamp_ntz").alias("time_end"),
    )


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS DOUBLE) AS lon,
       CAST(s_suppkey % 90 AS DOUBLE) AS lat FROM supplier
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS DOUBLE),
       CAST(c_custkey % 90 AS DOUBLE) FROM customer
""")
def geojson_features(spark, sf_dir):
    """Two feature collections, one per table, read alike and united."""

    def collections(name: str, key: str, label: str, nation: str):
        lat = F.col(key) % 90
        json = F.format_string(
            '{"type":"FeatureCollection","features":[{"type":"Feature","id":"%d",'
            '"properties":{"name":"%s"},"geometry":{"type":"Point","coordinates":[%d,%d]}}]}',
            key, label, nation, lat,
        )
        return documents.parse_features(table(spark, sf_dir, name).select(json.alias("j")), "j")

    both = collections("supplier", "s_suppkey", "s_name", "s_nationkey").unionByName(
        collections("customer", "c_custkey", "c_name", "c_nationkey")
    )
    return both.select("id", "name", "geom.lon", "geom.lat")


@query("""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS point, CAST(embedding[i] AS DOUBLE) AS value,
       -180e0 + (i - 1) * 0.25e0 AS lon, 18e0 + ((i - 1) % 8) * 0.25e0 AS lat
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""")
def unstack_grid(spark, sf_dir):
    """Vectors as values over grid points, joined to two coordinate arrays by position."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows = gridded.unstack_grid(vectors, "embedding")
    longest = vectors.agg(F.max(F.size("embedding")).alias("n"))
    span = F.sequence(F.lit(0), F.col("n") - 1)
    axes = longest.select(
        F.transform(span, lambda i: F.lit(-180.0) + i * F.lit(0.25)).alias("lon"),
        F.transform(span, lambda i: F.lit(18.0) + (i % 8) * F.lit(0.25)).alias("lat"),
    )
    placed = gridded.with_coordinates(rows, gridded.axis_rows(axes, ["lon", "lat"]))
    return placed.select(
        "vec_id", "point", F.col("value").cast("double").alias("value"), "lon", "lat"
    )


@query("SELECT n_nationkey, n_name FROM nation")
def refreshed_snapshot(spark, sf_dir):
    """A declared table, refreshed twice in full, then exported."""
    location = work_path(spark, "nations")
    name = "refreshed_" + location[-12:]
    tables.create_if_missing(spark, name, "n_nationkey int, n_name string", location)
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    for _ in range(2):
        tables.refresh_full(nations, name, location)
    path = tables.export_snapshot(spark.table(name), work_path(spark, "exports"), "nations")
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query("""
SELECT user_id, event_type, ts, CAST(NULL AS DOUBLE) AS value FROM events
UNION ALL
SELECT user_id, NULL, ts, value FROM events
""")
def union_by_name_files(spark, sf_dir):
    """Two sets of files whose columns differ, read as one."""
    events = table(spark, sf_dir, "events")
    left, right = work_path(spark, "left"), work_path(spark, "right")
    tables.write_parquet(events.select("user_id", "event_type", "ts"), left)
    tables.write_parquet(events.select("user_id", "ts", "value"), right)
    return files.read_union_by_name(spark, [left, right]).select(
        "user_id", "event_type", "ts", "value"
    )


@query("""
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS load FROM events
""")
def append_unseen(spark, sf_dir):
    """A second load over everything adds only what the first one, of the earlier half, lacks."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    path = work_path(spark, "loads")
    early = events.where("ts < timestamp_ntz'2024-01-16'")
    tables.append_new(early.withColumn("load", F.lit(1)), path, ["event_id"])
    for _ in range(2):
        tables.append_new(events.withColumn("load", F.lit(2)), path, ["event_id"])
    return spark.read.parquet(path).select("event_id", "load")


@query("SELECT nullif(user_id % 5, 0) AS station, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def append_null_keys(spark, sf_dir):
    """Loads whose key has missing values, repeated: a missing station equals a missing one."""
    station = F.when(F.col("user_id") % 5 > 0, (F.col("user_id") % 5).cast("long")).alias("station")
    rows = table(spark, sf_dir, "events").groupBy(station, "event_type").agg(F.min("event_id").alias("event_id"))
    path = work_path(spark, "null-keys")
    for _ in range(2):
        tables.append_new(rows, path, ["station", "event_type"])
    return spark.read.parquet(path)


@query("""
SELECT doc_id, n, CASE WHEN n > 1 THEN 'repeat' ELSE 'single' END AS kind
FROM (SELECT doc_id, CAST(2 AS BIGINT) AS n FROM documents)
""")
def repeated_interval_append(spark, sf_dir):
    """Blind appends of one range, twice: every row is there twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    path = work_path(spark, "blind")
    for _ in range(2):
        tables.append_interval(docs, path)
    counted = spark.read.parquet(path).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("kind", F.when(F.col("n") > 1, "repeat").otherwise("single"))


@query(f"""
SELECT filename, CAST(len(tokens) AS INTEGER) AS n_fields, md5(array_to_string(tokens, '|')) AS digest
FROM (SELECT {padded_sql("user_id")} AS filename,
             [strftime(ts, '%Y-%m-%d'), event_type] AS tokens FROM events)
""")
def latest_observation_lines(spark, sf_dir):
    """Latest-observation layout: comment lines go, ids starting with letters stay."""
    events = table(spark, sf_dir, "events")
    rows = events.select(
        text.zero_pad(F.col("user_id"), 5).alias("filename"),
        F.explode(
            F.array(
                F.lit("#STN LAT LON"),
                F.lit("   "),
                F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("\t "), F.col("event_type")),
            )
        ).alias("value"),
    )
    parsed = files.observation_lines(rows, "value", latest=True)
    return parsed.select(
        "filename",
        F.size("line").alias("n_fields"),
        F.md5(F.array_join("line", "|")).alias("digest"),
    )


