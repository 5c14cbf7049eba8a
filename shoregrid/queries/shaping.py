"""Filters, null handling and token parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoregrid.functions import grid, moments, numbers, text
from shoregrid.operators.incremental import in_manifest
from shoregrid.plans.archives import wind_component
from shoregrid.plans.silver import between
from shoregrid.queries import query
from shoregrid.queries.inputs import LAT_SQL, LON_SQL, station_lat, station_lon, table
from shoregrid.queries.joins import order_intervals
from shoregrid.queries.scans import TOKEN_SQL


@query("""
SELECT event_id, ts FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-14 23:59:59'
""")
def between_times(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-08", "2024-01-14 23:59:59"))
    return between(table(spark, sf_dir, "events"), start, end, "ts").select("event_id", "ts")


@query("""
SELECT event_id, CASE WHEN value <> 0.5e0 AND value <> 99e0 THEN value END AS reading FROM events
""")
def sentinels_to_null(spark, sf_dir):
    reading = numbers.sentinel_to_null(F.col("value"), 0.5, 99.0)
    return table(spark, sf_dir, "events").select("event_id", reading.alias("reading"))


NUMBER_SQL = "regexp_full_match(t, '\\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\s*')"


@query(f"""
SELECT doc_id, CAST(count(num) AS BIGINT) AS n_numbers,
       round(sum(coalesce(num, 999.9e0)), 4) AS filled_sum,
       CAST(sum(coalesce(try_cast(round(num) AS INTEGER), 999)) AS BIGINT) AS whole_sum
FROM (SELECT doc_id, CASE WHEN {NUMBER_SQL} THEN try_cast(t AS DOUBLE) END AS num
      FROM (SELECT doc_id, unnest({TOKEN_SQL.format("text")}) AS t FROM documents))
GROUP BY doc_id
""")
def parsed_tokens(spark, sf_dir):
    """Every token of every document parsed with a fill for what is no number."""
    token = F.col("token")
    tokens = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(text.fields(F.col("text"))).alias("token")
    )
    return tokens.groupBy("doc_id").agg(
        F.count(numbers.parse_double(token)).alias("n_numbers"),
        numbers.round_half_away(F.sum(numbers.parse_double_or(token, 999.9)), 4).alias(
            "filled_sum"
        ),
        F.sum(numbers.parse_int_or(token, 999)).alias("whole_sum"),
    )


@query(f"""
SELECT doc_id, first_pos, tokens[first_pos] AS field, tokens[first_pos + 7] AS later_field
FROM (SELECT doc_id, {TOKEN_SQL.format("text")} AS tokens,
             CASE WHEN lang IN ('en', 'de') THEN 5 ELSE 6 END AS first_pos FROM documents)
""")
def layout_fields(spark, sf_dir):
    """Fields at positions that depend on the row; outside the line they are NULL."""
    line, first = text.fields(F.col("text")), F.col("first_pos")
    return (
        table(spark, sf_dir, "documents")
        .withColumn("first_pos", F.when(F.col("lang").isin("en", "de"), 5).otherwise(6))
        .select(
            "doc_id",
            "first_pos",
            text.field_at(line, first).alias("field"),
            text.field_at(line, first + 7).alias("later_field"),
        )
    )


@query("""
SELECT o_orderkey, start_time FROM (
    SELECT o_orderkey, o_orderdate AS start_time,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
               - INTERVAL 1 MICROSECOND AS end_time
    FROM orders)
WHERE start_time <= TIMESTAMP '1997-06-30'
  AND coalesce(end_time, TIMESTAMP '9999-01-01') >= TIMESTAMP '1997-06-01'
""")
def interval_overlaps(spark, sf_dir):
    """Intervals that touch a query range; open ones last forever."""
    last = F.coalesce("end_time", F.lit("9999-01-01").cast("timestamp_ntz"))
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("1997-06-01", "1997-06-30"))
    return (
        order_intervals(spark, sf_dir)
        .where(moments.overlaps(F.col("start_time"), last, start, end))
        .select("o_orderkey", "start_time")
    )


@query(f"""
SELECT event_id FROM events
WHERE {LON_SQL} BETWEEN -159e0 AND -155e0 AND {LAT_SQL} BETWEEN 18e0 AND 19.9e0
""")
def within_box(spark, sf_dir):
    user = F.col("user_id")
    inside = grid.within_box(station_lon(user), station_lat(user), -159.0, 18.0, -155.0, 19.9)
    return table(spark, sf_dir, "events").where(inside).select("event_id")


@query("SELECT event_id, user_id FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier)")
def manifest_members(spark, sf_dir):
    manifest = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return in_manifest(events, manifest, ["user_id"])


@query("""
SELECT p_partkey, CASE WHEN regexp_matches(p_brand, '(?i)BRAND#1') THEN 'VAR_10V' ELSE 'VAR_10U' END AS component,
       p_name LIKE '%red%' AS is_red
FROM part
WHERE regexp_matches(p_type, '(?i)^(eco|pro|std|sta|lar|med|sma)') AND p_name NOT LIKE '%blue%' AND p_brand <> 'Brand#25'
""")
def pattern_filters(spark, sf_dir):
    """Regular expressions, LIKE and inequality on text, and a label made from a match."""
    part = table(spark, sf_dir, "part").where(
        F.col("p_type").rlike("(?i)^(eco|pro|std|sta|lar|med|sma)")
        & ~F.col("p_name").like("%blue%")
        & (F.col("p_brand") != "Brand#25")
    )
    url = F.when(F.col("p_brand").rlike("(?i)BRAND#1"), "x_10V").otherwise("x_10u")
    return part.select(
        "p_partkey",
        wind_component(url).alias("component"),
        F.col("p_name").like("%red%").alias("is_red"),
    )


@query("""
SELECT e.event_id, e.value * 2e0 AS doubled, e.value * 2e0 + 1e0 AS shifted, c.c_name
FROM events e LEFT JOIN customer c ON e.event_id = c.c_custkey
WHERE e.value >= 5e0 AND e.ts > TIMESTAMP '2024-01-02 23:59:59'
  AND c.c_name IS NOT NULL AND e.value IS NOT NULL
""")
def plausible_complete_rows(spark, sf_dir):
    """A plausibility floor, a lower time bound and complete rows only; aliases are reused."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("event_id"), "c_name"
    )
    joined = table(spark, sf_dir, "events").join(customers, "event_id", "left")
    kept = joined.where(
        (F.col("value") >= 5.0) & (F.col("ts") > F.lit("2024-01-02 23:59:59").cast("timestamp_ntz"))
    ).dropna(subset=["c_name", "value"])
    return kept.selectExpr("event_id", "value * 2D AS doubled", "doubled + 1D AS shifted", "c_name")
