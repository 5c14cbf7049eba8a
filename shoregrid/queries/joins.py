"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.functions import text
from shoregrid.functions.moments import truncate
from shoregrid.functions.numbers import round_half_away
from shoregrid.operators import incremental
from shoregrid.operators import joins as ops
from shoregrid.operators.sized import join_dimension
from shoregrid.queries import query
from shoregrid.queries.inputs import table


def order_intervals(spark, sf_dir):
    """Each customer's orders as intervals that end just before the next order."""
    ordered = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("start_time"),
        (F.lead("o_orderdate").over(ordered) - F.expr("INTERVAL '0.000001' SECOND")).alias(
            "end_time"
        ),
    )


@query("""
SELECT o_orderkey, c_name, c_nationkey FROM orders JOIN customer ON o_custkey = c_custkey
""")
def fact_dimension(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return join_dimension(orders, customers, ["o_custkey"]).drop("o_custkey")


@query("""
WITH spans AS (
    SELECT o_orderkey AS held_order, o_custkey, o_orderdate AS start_time,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
               - INTERVAL 1 MICROSECOND AS end_time
    FROM orders)
SELECT l.l_orderkey, l.l_linenumber, s.held_order, s.start_time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN spans s ON s.o_custkey = o.o_custkey
            AND l.l_shipdate BETWEEN s.start_time AND coalesce(s.end_time, l.l_shipdate)
""")
def scd_join(spark, sf_dir):
    """Shipments with the order interval of their customer that holds at the shipping date."""
    owner = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer")
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    facts = join_dimension(items, owner, ["l_orderkey"])
    spans = order_intervals(spark, sf_dir).withColumnRenamed("o_orderkey", "held_order")
    return ops.scd_join(facts, spans, "customer", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "held_order", "start_time"
    )


def _hourly(spark, sf_dir, kinds: tuple[str, ...], name: str):
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin(*kinds))
        .groupBy("user_id", truncate("HOUR", F.col("ts")).alias("hour"))
        .agg(F.avg("value").alias(name))
    )


@query("""
WITH h AS (
    SELECT user_id, date_trunc('hour', ts) AS hour, avg(value) AS v,
           CASE WHEN event_type IN ('view', 'error') THEN 'own' WHEN event_type IN ('click', 'signup') THEN 'gridded'
                ELSE 'gauge' END AS role
    FROM events GROUP BY user_id, hour, role)
SELECT b.user_id, b.hour, round(coalesce(c.v, b.v), 6) AS wind, round(coalesce(p.v / 1000e0, b.v), 6) AS tide
FROM (SELECT * FROM h WHERE role = 'own') b
LEFT JOIN (SELECT * FROM h WHERE role = 'gridded') c USING (user_id, hour)
LEFT JOIN (SELECT * FROM h WHERE role = 'gauge') p USING (user_id, hour)
""")
def fallback_enrichment(spark, sf_dir):
    """One source enriched by two others, falling back on its own value."""
    base = _hourly(spark, sf_dir, ("view", "error"), "own")
    keys = ["user_id", "hour"]
    joined = base.join(_hourly(spark, sf_dir, ("click", "signup"), "gridded"), keys, "left").join(
        _hourly(spark, sf_dir, ("purchase",), "gauge"), keys, "left"
    )
    return joined.select(
        *keys,
        round_half_away(F.coalesce("gridded", "own"), 6).alias("wind"),
        round_half_away(F.coalesce(F.col("gauge") / 1000.0, F.col("own")), 6).alias("tide"),
    )


@query("""
SELECT n_name, s_name FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey
WHERE s_acctbal > 0
""")
def nullified_left_join(spark, sf_dir):
    """A left join whose filter needs the right side: written as the inner join it is."""
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), "n_name"
    )
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0")
    return join_dimension(suppliers.select("s_nationkey", "s_name"), nations, ["s_nationkey"]).drop(
        "s_nationkey"
    )


@query("""
SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderkey IS NULL
""")
def without_orders(spark, sf_dir):
    """Customers that never placed an order."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return incremental.unseen(customers, done, ["c_custkey"])


@query("SELECT c_custkey, c_name FROM customer LEFT JOIN events ON user_id = c_custkey WHERE event_id IS NULL")
def without_events(spark, sf_dir):
    """Customers whose number no event carries."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    done = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    return incremental.unseen(customers, done, ["c_custkey"])


@query("""
SELECT event_id, user_id, n_name FROM events JOIN nation
  ON user_id % 25 = n_nationkey AND regexp_matches(event_type, lower(substring(n_name, 2, 1)))
""")
def pattern_residual_join(spark, sf_dir):
    """Equal keys and, of those, only pairs whose text matches the other side's pattern."""
    events = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", (F.col("user_id") % 25).cast("int").alias("key")
    )
    nations = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("key"), "n_name", F.lower(F.substring("n_name", 2, 1)).alias("p")
    )
    joined = join_dimension(events, nations, ["key"], residual=F.regexp_like("event_type", F.col("p")))
    return joined.select("event_id", "user_id", "n_name")


@query("""
SELECT e.event_id, e.user_id, e.ts FROM events e
LEFT JOIN (SELECT user_id, max(ts) AS newest FROM events WHERE ts < TIMESTAMP '2024-01-15' AND user_id % 7 > 0
           GROUP BY user_id) m
  ON e.user_id = m.user_id WHERE m.newest IS NULL OR e.ts > m.newest
""")
def newer_than_archive(spark, sf_dir):
    """Rows past the newest archived one of their station; every seventh station was never archived."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    archive = events.where("ts < timestamp_ntz'2024-01-15' AND user_id % 7 > 0")
    return ops.newer_than(events, archive, "user_id", "ts")


@query("""
SELECT p.page_id, h.host, h.pages_of_host FROM pages p
JOIN (SELECT split_part(url, '/', 3) AS host, count(*) AS pages_of_host FROM pages GROUP BY 1) h
  ON split_part(p.url, '/', 3) = h.host
""")
def host_join(spark, sf_dir):
    """A join on a key taken out of the address."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", text.part(F.col("url"), "/", 3).alias("host")
    )
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages_of_host"))
    return join_dimension(pages, hosts, ["host"])


@query("""
WITH part_of AS (SELECT user_id, date_trunc('hour', ts) AS hour, event_type, value FROM events)
SELECT user_id, hour, round(avg(u.value), 6) AS u, round(avg(v.value), 6) AS v
FROM (SELECT * FROM part_of WHERE event_type = 'click') u
JOIN (SELECT * FROM part_of WHERE event_type = 'view') v USING (user_id, hour)
GROUP BY user_id, hour
""")
def paired_components(spark, sf_dir):
    """Averages of two components of the same place and hour."""
    rows = table(spark, sf_dir, "events").select(
        "user_id", truncate("HOUR", F.col("ts")).alias("hour"), "event_type", "value"
    )
    paired = ops.pair_components(rows, ["user_id", "hour"], "event_type", "value", "click", "view")
    return paired.select(
        "user_id",
        "hour",
        round_half_away(F.col("first_avg"), 6).alias("u"),
        round_half_away(F.col("second_avg"), 6).alias("v"),
    )


@query("""
WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
     v AS (SELECT event_id AS view_id, user_id, ts AS view_ts, value FROM events WHERE event_type = 'view')
SELECT event_id, view_id, view_ts FROM (
    SELECT p.event_id, v.view_id, v.view_ts,
           row_number() OVER (PARTITION BY p.event_id
               ORDER BY abs(epoch_us(p.ts) - epoch_us(v.view_ts)), v.view_ts, v.view_id) AS rn
    FROM p JOIN v ON p.user_id = v.user_id
     AND v.view_ts BETWEEN p.ts - INTERVAL 30 MINUTE AND p.ts + INTERVAL 30 MINUTE)
WHERE rn = 1
""")
def nearest_in_time(spark, sf_dir):
    """Each purchase with the view of the same user nearest in time, 30 minutes apart at most."""
    events = table(spark, sf_dir, "events")
    points = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    series = events.where("event_type = 'view'").select(
        "user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts")
    )
    found = ops.nearest_in_time(points, series, "user_id", "ts", "view_id", "view_ts", 30)
    return found.select("event_id", "view_id", "view_ts")


@query("""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
""")
def active_members(spark, sf_dir):
    """Facts of members that are active at all."""
    active = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    keys = active.select(F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return incremental.in_manifest(customers, keys, ["c_custkey"])


