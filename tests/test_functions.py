"""Column expressions and operators on small inputs with answers worked out by hand."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoregrid.functions import arrays, grid, media, moments, numbers, text, wind
from shoregrid.operators import audit, incremental, interpolate, joins, ranking, search, sized, spatial
from shoregrid.sources import files

T = datetime


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_nearest_hour_goes_up_at_half(spark):
    times = ["09:29:59", "09:30:00", "10:29:59", "10:30:00"]
    df = spark.createDataFrame([(T.fromisoformat(f"2024-01-01 {t}"),) for t in times], "t timestamp_ntz")
    assert [r[0].hour for r in df.select(moments.nearest_hour(F.col("t"))).collect()] == [9, 10, 10, 11]


def test_number_parsing(spark):
    got = one(
        spark,
        numbers.parse_double(F.lit("1.5")),
        numbers.parse_double(F.lit("1d")),
        numbers.parse_double(F.lit("MM")),
        numbers.parse_double(F.lit("1e2")),
        numbers.parse_double(F.lit("NaN")),
        numbers.parse_double_or(F.lit("x"), 99.0),
        numbers.parse_int_or(F.lit("3.7"), 999),
        numbers.parse_int_or(F.lit("99999999999"), 999),
        numbers.to_int_half_even(F.lit(2.5)),
        numbers.to_int_half_even(F.lit(999.9)),
    )
    assert tuple(got) == (1.5, None, None, 100.0, None, 99.0, 4, 999, 2, 1000)


def test_rounding_uses_the_binary_value(spark):
    got = one(
        spark,
        numbers.round_half_away(F.lit(1.005), 2),
        numbers.round_half_away(F.lit(-2.5), 0),
        numbers.round_half_away(F.lit(0.125), 2),
        numbers.round_half_away(F.lit(8633045357477909.0), 4),
    )
    assert tuple(got) == (1.0, -3.0, 0.13, 8633045357477909.0)


def test_sentinels(spark):
    value = F.col("v")
    df = spark.createDataFrame([(99.0,), (999.9,), (1.0,), (None,)], "v double")
    got = df.select(numbers.sentinel_to_null(value, 99.0, 999.9)).collect()
    assert [r[0] for r in got] == [None, None, 1.0, None]


@pytest.mark.parametrize("u,v,expected", [(0, -1, 0), (-1, 0, 90), (0, 1, 180), (1, 0, 270)])
def test_wind_direction(spark, u, v, expected):
    speed, direction = one(
        spark, wind.wind_speed(F.lit(float(u)), F.lit(float(v))), wind.wind_from(F.lit(float(u)), F.lit(float(v)))
    )
    assert speed == 1.0 and math.isclose(direction, expected, abs_tol=1e-9)


def test_observation_time(spark):
    parts = [F.lit(x) for x in ("2024", "02", "30", "01")]
    ok = [F.lit(x) for x in ("2024", "02", "29", "01")]
    bad, high, plain = one(
        spark,
        moments.observation_time(*parts, F.lit("10")),
        moments.observation_time(*ok, F.lit("75")).cast("timestamp_ntz"),
        moments.observation_time(*ok).cast("timestamp_ntz"),
    )
    assert bad is None and high == T(2024, 2, 29, 1) and plain == T(2024, 2, 29, 1)


def test_year_slices_of_a_year_and_a_half(spark):
    df = spark.createDataFrame(
        [(T(2024, 3, 1), T(2025, 9, 1)), (T(2024, 1, 1), T(2024, 1, 1)), (T(2000, 1, 1), T(2026, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = incremental.yearly_intervals(df, "a", "b").collect()
    first = [(r.slice_start, r.slice_end) for r in got if r.a == T(2024, 3, 1)]
    assert first == [
        (T(2024, 3, 1), T(2025, 3, 1, 23, 59, 59, 999999)),
        (T(2025, 3, 2), T(2025, 9, 1)),
    ]
    assert [(r.slice_start, r.slice_end) for r in got if r.a == T(2024, 1, 1)] == [(T(2024, 1, 1), T(2024, 1, 1))]
    long = sorted(r.slice_start for r in got if r.a == T(2000, 1, 1))
    assert long == [T(y, 1, 1) for y in range(2000, 2026)]


def test_cells_and_disks(spark):
    cell, lon, lat, edge, pole = one(
        spark,
        grid.cell_of(F.lit(-157.8), F.lit(21.3)),
        grid.centre_lon(grid.cell_of(F.lit(-157.8), F.lit(21.3))),
        grid.centre_lat(grid.cell_of(F.lit(-157.8), F.lit(21.3))),
        grid.disk(F.lit(720 * 100), 1),
        grid.disk(F.lit(0), 2),
    )
    assert (cell, lon, lat) == (222 * 720 + 44, -157.75, 21.25)
    assert sorted(edge) == sorted(r * 720 + c for r in (99, 100, 101) for c in (719, 0, 1))
    assert len(pole) == 15 and len(set(pole)) == 15


def test_unknown_places_stay_unknown(spark):
    none, lon = F.lit(None).cast("double"), F.lit(-157.0)
    got = one(
        spark,
        grid.cell_of(lon, none),
        grid.cell_of(none, lon),
        grid.great_circle_m(lon, none, lon, lon),
        grid.quadkey(lon, none, 6),
        numbers.round_half_away(none, 2),
    )
    assert tuple(got) == (None,) * 5


def test_point_text(spark):
    got, bad = one(
        spark,
        grid.point_from_text(F.lit("POINT (-157.5 21.25)")),
        grid.point_from_text(F.lit("LINESTRING (0 0, 1 1)")),
    )
    assert (got.lon, got.lat, bad) == (-157.5, 21.25, None)


def test_text_helpers(spark):
    got = one(
        spark,
        text.tail_slice(F.lit("data/h001a.csv"), -8, -6),
        text.tail_slice(F.lit("data/h001a.csv"), -5, -5),
        text.replace_first(F.lit("a.nc.nc"), "nc", "parquet"),
        text.path_value(F.lit("/x/year=2024-01-01%2000%3A00/station_id=46001/p.parquet"), "year"),
        text.path_value(F.lit("/x/p.parquet"), "year"),
        text.fields(F.lit(" 2024  01\t2")),
        text.zero_pad(F.lit(1234), 3),
        arrays.concat_lists("int", F.array(F.lit(1)), F.lit(None).cast("array<int>")),
    )
    assert tuple(got)[:5] == ("001", "a", "a.parquet.nc", "2024-01-01 00:00", None)
    assert got[5] == ["", "2024", "01", "2"] and got[6] == "1234" and got[7] == [1]


def test_media_names_and_tags(spark):
    when, spot, photo, dms = one(
        spark,
        media.clip_time(F.lit("clip_laniakea_20260102_0730.mp4")).cast("timestamp_ntz"),
        media.clip_spot(F.lit("clip_laniakea_20260102_0730(1).mp4")),
        media.photo_time(F.lit("2026:01:02 07:30:00"), F.lit("-10:00")).cast("timestamp_ntz"),
        media.to_dms(F.lit(-158.0852)),
    )
    assert when == photo == T(2026, 1, 2, 17, 30) and spot == "laniakea"
    assert (dms.degrees, dms.minutes, dms.seconds) == (158, 5, 6)


def near_and_readings(spark):
    near = spark.createDataFrame(
        [(1, "a", 0.0, None), (1, "b", 1.0, 1.0), (1, "c", 2.0, 0.25), (2, "b", 1.0, 1.0), (2, "c", 2.0, 0.25)],
        "cell long, station string, dist double, weight double",
    )
    t = T(2024, 1, 1)
    readings = spark.createDataFrame(
        [("a", t, 10.0, None), ("b", t, 4.0, None), ("c", t, 1.0, 8.0)],
        "station string, ts timestamp_ntz, v double, sparse double",
    )
    return near, readings


def test_idw_exact_hit_and_weights(spark):
    near, readings = near_and_readings(spark)
    rows = {r.cell: r for r in interpolate.idw(near, readings, "station", "ts", ["v", "sparse"]).collect()}
    assert (rows[1].idw_v, rows[2].idw_v, rows[2].idw_sparse) == (10.0, 3.4, 8.0)
    old = interpolate.idw(near, readings, "station", "ts", ["sparse"], weigh_missing=True).collect()
    assert {r.cell: r.idw_sparse for r in old}[2] == 1.6


def test_idw_counts_repeated_readings(spark):
    near, readings = near_and_readings(spark)
    twice = readings.unionByName(readings.where("station = 'b'"))
    got = {r.cell: r.idw_v for r in interpolate.idw(near, twice, "station", "ts", ["v"]).collect()}
    assert got[2] == 3.67  # (4 + 4 + 0.25) / 2.25


def test_hourly_mean_on_the_compass(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1, 0, 5), 350.0), (1, T(2024, 1, 1, 0, 6), 10.0)], "s long, t timestamp_ntz, d double")
    plain = interpolate.hourly_mean(df, ["s"], "t", {"d": (999,)}).first().d
    turned = interpolate.hourly_mean(df, ["s"], "t", {"d": (999,)}, circular=("d",)).first().d
    assert plain == 180.0 and min(turned, 360 - turned) < 1e-6


def history_and_facts(spark, n):
    spans = [("hot", i, T(2020, 1, 1, i // 60 % 24, i % 60), T(2020, 1, 1, i // 60 % 24, i % 60, 59, 999999)) for i in range(n)]
    spans[-1] = (*spans[-1][:3], None)
    spans.append(("cold", -1, T(2019, 1, 1), None))
    history = spark.createDataFrame(spans, "k string, sk int, start_time timestamp_ntz, end_time timestamp_ntz")
    facts = spark.createDataFrame(
        [("hot", i, T(2020, 1, 1, i // 60 % 24, i % 60, 30)) for i in range(n)]
        + [("hot", -5, T(2019, 1, 1)), ("hot", -6, T(2030, 1, 1)), ("cold", -7, T(2030, 1, 1)), (None, -8, T(2030, 1, 1))],
        "k string, id int, ts timestamp_ntz",
    )
    return history, facts


@pytest.mark.parametrize("limit", ["10485760", "-1"])
def test_scd_join_with_a_long_history(spark, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        history, facts = history_and_facts(spark, 600)
        got = {(r.id, r.sk) for r in joins.scd_join(facts, history, "k", "ts").collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {(i, i) for i in range(600)} | {(-6, 599), (-7, -1)}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_dimension_same_both_ways(spark, how):
    fact = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"), "id"
    )
    dim = spark.range(0, 60, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    residual = F.col("w") + 0 <= F.col("id")
    results = []
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        df = sized.join_dimension(fact, dim, ["k"], how, residual, hot_rows=500)
        results.append(sorted(df.collect(), key=repr))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain = fact.alias("f").join(dim.alias("d"), (F.col("f.k") == F.col("d.k")) & residual, how)
    assert results[0] == results[1] and len(results[0]) == plain.count() > 0


def test_nearest_in_time_edges(spark):
    points = spark.createDataFrame(
        [(1, "a", T(2024, 1, 1, 12)), (2, "a", T(2024, 1, 1, 12)), (3, "b", T(2024, 1, 1, 12)), (4, "c", T(2024, 1, 1, 12)), (5, "d", T(2024, 1, 1, 0, 0, 0, 5))],
        "id int, cell string, ts timestamp_ntz",
    )
    series = spark.createDataFrame(
        [
            ("a", 10, T(2024, 1, 1, 11, 40)), ("a", 11, T(2024, 1, 1, 12, 10)), ("a", 12, T(2024, 1, 1, 12, 10)),
            ("b", 20, T(2024, 1, 1, 11, 30)), ("b", 21, T(2024, 1, 1, 12, 30)),
            ("c", 30, T(2024, 1, 1, 11, 29, 59, 999999)),
            ("d", 40, T(2023, 12, 31, 23, 59, 59, 999999)), ("d", 41, T(2024, 1, 1, 0, 0, 0, 8)),
        ],
        "cell string, sid int, sts timestamp_ntz",
    )
    got = joins.nearest_in_time(points, series, "cell", "ts", "sid", "sts", 30).collect()
    assert {r.id: r.sid for r in got} == {1: 11, 2: 11, 3: 20, 5: 41}


@pytest.fixture
def small_partitions(spark):
    """Range partitions stay as many as asked for, however little they hold."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def by_one_window(df, keys):
    from pyspark.sql.window import Window

    order = Window.partitionBy(*keys).orderBy(F.col("x").asc_nulls_first(), F.col("id").asc_nulls_first())
    return sorted(df.withColumn("pos", F.row_number().over(order).cast("long")).collect(), key=repr)


def test_numbering_over_partitions_equals_one_window(spark, small_partitions):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("k"), (F.col("id") * 7919 % 1000).alias("x"))
    for keys in ([], ["k"]):
        assert sorted(ranking.numbered(df, keys, F.col("x"), "id", "pos").collect(), key=repr) == by_one_window(df, keys)


def test_numbering_of_a_hot_key_with_a_text_tie(spark, small_partitions):
    """60% of the rows have one key and one order value; they are parted by the text that breaks the tie."""
    hot = F.col("i") % 5 < 3
    df = spark.range(4000).toDF("i").select(
        F.concat(F.lit("t"), F.pmod(F.col("i") * 7919, F.lit(4000))).alias("id"),
        F.when(hot, "hot").when(F.col("i") % 11 == 0, None).otherwise(F.concat(F.lit("k"), F.col("i") % 40)).alias("k"),
        F.when(hot, 500).when(F.col("i") % 7 == 0, None).otherwise(F.col("i") % 1000).alias("x"),
    )
    for keys in (["k"], []):
        assert sorted(ranking.numbered(df, keys, F.col("x"), "id", "pos").collect(), key=repr) == by_one_window(df, keys)
    parted = ranking._parted(df, ["k"], F.col("x"), "id")
    counts = [r["count"] for r in parted.where("k = 'hot'").groupBy("_part").count().collect()]
    assert len(counts) >= 4 and max(counts) < 1000


def test_numbering_plan_reads_twice_and_broadcasts_nothing(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("k"), (F.col("id") % 10).alias("x"))
    for made in (ranking.numbered(df, ["k"], F.col("x"), "id"), ranking.numbered(df, [], F.col("x"), "id")):
        plan = made._jdf.queryExecution().sparkPlan().toString()  # its one subquery is the second scan
        assert plan.count("FileScan parquet") == 1 and "scalar-subquery" in plan
        assert "Broadcast" not in plan and "Join" not in plan


def test_numbering_of_nothing(spark):
    df = spark.range(0).select("id", F.lit("a").alias("k"), F.lit(1).alias("x"))
    assert ranking.numbered(df, ["k"], F.col("x"), "id").collect() == []


def test_even_split_and_batches(spark):
    df = spark.range(23).toDF("id")
    tiles = ranking.even_split(df, 4, F.col("id"), "id").collect()
    sizes = [sum(r.tile == t for r in tiles) for t in (1, 2, 3, 4)]
    assert sizes == [6, 6, 6, 5]
    got = ranking.batches(df, 5, F.col("id"), "id", ["id"]).orderBy("batch").collect()
    assert [[i.id for i in r["items"]] for r in got][-1] == [20, 21, 22] and len(got) == 5


def test_more_tiles_than_rows(spark):
    df = spark.range(3).toDF("id")
    assert sorted(r.tile for r in ranking.even_split(df, 5, F.col("id"), "id").collect()) == [1, 2, 3]


def test_similar_vectors_is_exact(spark):
    import random

    random.seed(1)
    rows = [(i, [float(i)] + [random.uniform(0, 60) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "rid long, v array<double>")
    queries = df.where("rid < 20").select(F.col("rid").alias("qid"), "v")
    got = {(r.qid, r.rid) for r in search.similar_vectors(queries, df, ["qid"], "v", 25.0).collect()}
    want = {
        (q, r) for q, a in rows[:20] for r, b in rows if math.dist(a[1:], b[1:]) < 25.0
    }
    assert got == want and len(want) > 20


def test_cover_of_lines_wraps_at_the_dateline(spark):
    lines = spark.createDataFrame(
        [([(179.9, 0.25), (-179.9, 0.25)],), ([(0.25, 10.25), (1.25, 10.25), (1.25, 11.25)],)],
        "line array<struct<lon double, lat double>>",
    )
    got = {r.cell for r in spatial.cover_buffer(spatial.segments(lines, "line"), 0.3).collect()}
    row, top = 180, 200
    assert got == {row * 720 + 719, row * 720} | {top * 720 + c for c in (360, 361, 362)} | {r * 720 + 362 for r in (201, 202)}


def test_cover_equals_brute_force(spark):
    lines = spark.createDataFrame([([(-158.3, 21.2), (-157.1, 21.9), (-155.2, 19.4)],)], "line array<struct<lon double, lat double>>")
    got = {r.cell for r in spatial.cover_buffer(spatial.segments(lines, "line"), 0.6).collect()}

    def gap(px, py, a, b):
        dx, dy = b[0] - a[0], b[1] - a[1]
        t = min(max(((px - a[0]) * dx + (py - a[1]) * dy) / (dx * dx + dy * dy), 0), 1)
        return math.hypot(px - a[0] - t * dx, py - a[1] - t * dy)

    pts = [(-158.3, 21.2), (-157.1, 21.9), (-155.2, 19.4)]
    want = {
        iy * 720 + ix
        for iy in range(210, 235)
        for ix in range(35, 60)
        if min(gap((ix + 0.5) / 2 - 180, (iy + 0.5) / 2 - 90, a, b) for a, b in zip(pts, pts[1:])) <= 0.6
    }
    assert got == want


def test_disk_join_with_given_neighbours(spark):
    stations = spark.createDataFrame([(7, 500, -157.9, 21.3)], "station int, station_cell long, lon double, lat double")
    cells = spark.createDataFrame([(501,), (502,)], "cell long")
    neighbours = spark.createDataFrame([(500, 501), (500, 503)], "station_cell long, cell long")
    centres = spark.createDataFrame([(501, -157.9, 21.3)], "cell long, centre_lon double, centre_lat double")
    got = spatial.disk_join(cells, stations, "station", neighbours=neighbours, centres=centres).collect()
    assert [(r.cell, r.station, r.dist, r.weight) for r in got] == [(501, 7, 0.0, None)]


def test_idw_stays_between_inputs(spark):
    near, readings = near_and_readings(spark)
    for r in interpolate.idw(near, readings, "station", "ts", ["v"]).collect():
        assert 1.0 <= r.idw_v <= 10.0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "a int, b int")
    assert [(r.a, r.n) for r in audit.duplicates(df, ["a", "b"]).collect()] == [(1, 2)]


def test_skip_first(spark):
    assert sorted(r.id for r in ranking.skip_first(spark.range(4).toDF("id"), "id").collect()) == [1, 2, 3]


def test_interpolation_by_tiles_equals_broadcast_and_writes_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    cells = spark.createDataFrame([(int(r * 720 + c),) for r in range(90, 130) for c in range(40)], "cell long")
    places = [(f"s{k}", float(rng.uniform(-180, -160)), float(rng.uniform(-45, -25))) for k in range(60)]
    stations = spark.createDataFrame(places, "station string, lon double, lat double")
    stations = stations.withColumn("station_cell", grid.cell_of(F.col("lon"), F.col("lat")))
    near = spatial.disk_join(cells, stations, "station")
    start = datetime(2024, 1, 1)
    rows = []
    for k in range(3000):  # half of the rows are of one station, some values are missing, some rows repeat
        name = "s0" if k % 2 else f"s{int(rng.integers(60))}"
        value = None if k % 7 == 0 else float(rng.integers(100))
        rows += [(name, start + timedelta(hours=int(rng.integers(50))), value)] * (2 if k % 11 == 0 else 1)
    readings = spark.createDataFrame([*rows, (None, start, 1.0), ("elsewhere", start, 1.0)], "station string, ts timestamp, v double")

    def run(links=near):
        return {(r.cell, r.ts): r.idw_v for r in interpolate.idw(links, readings, "station", "ts", ["v"]).collect()}

    want = run()
    assert want
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        monkeypatch.setattr(interpolate, "settled", None)  # nothing may be written
        assert run() == want
        named = near.withColumn("cell", F.concat(F.lit("c"), "cell"))
        assert {(int(c[1:]), t): v for (c, t), v in run(named).items()} == want
        assert interpolate.idw(near.limit(0), readings, "station", "ts", ["v"]).count() == 0
        frame = interpolate.idw(near, readings, "station", "ts", ["v"])
        plan = frame._jdf.queryExecution().executedPlan().toString()
        last = plan[: plan.index("Generate")]
        assert "Exchange" not in last, "the unfolded rows must be aggregated where they arise"
    finally:
        spark.conf.set(key, old)


def test_readings_travel_in_lists(spark):
    """A packed row of links goes with many readings, not with each."""
    hours = spark.range(1000).select(F.lit("s").alias("station"), (F.lit(datetime(2024, 1, 1)) + F.make_interval(hours="id")).alias("ts"), "id")
    minutes = spark.range(1000).select(F.lit("t").alias("station"), (F.lit(datetime(2024, 1, 1)) + F.make_interval(mins="id")).alias("ts"), "id")
    lists = interpolate.in_lists(hours.union(minutes), "station", "ts").collect()
    assert len(lists) <= 16 and max(len(r["_rows"]) for r in lists) <= interpolate.CHUNK_ROWS
    assert sorted((r.station, x.id) for r in lists for x in r["_rows"]) == [(s, i) for s in "st" for i in range(1000)]


def test_tiles_hold_squares_of_cells(spark):
    rows = spark.createDataFrame([(r * 720 + c, r // 16 * 45 + c // 16) for r in (0, 15, 16, 359) for c in (0, 15, 16, 719)], "cell long, want long")
    assert rows.where(grid.tile(F.col("cell")) != F.col("want")).count() == 0


@pytest.mark.parametrize("levels", [0, 1, 2, 4])
def test_listing_by_tasks_equals_the_file_index(spark, tmp_path, levels):
    for name in ("a.txt", "day=1/b.txt", "day=1/c.csv", "day=1/deep/er/d.txt", "_day=2/e.txt", "_tmp/f.txt", ".g.txt", "x y/h%3A.txt"):
        path = tmp_path / "lake" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)
    (tmp_path / "lake" / "empty").mkdir()
    base = f"{tmp_path}/lake"
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    for pattern in ("*", "*.txt", "[ab].???"):
        index = read.option("pathGlobFilter", pattern).load(base).select("path", "modificationTime", "length")
        want = sorted((r.path, r.length, r.modificationTime.replace(microsecond=0)) for r in index.collect())
        found = files.list_files(spark, base, pattern, levels).collect()
        assert sorted((r.path, r.length, r.modified.replace(microsecond=0)) for r in found) == want
    assert files.list_files(spark, f"{base}/empty").count() == 0
    with pytest.raises(Exception, match="missing"):
        files.list_files(spark, f"{base}/missing").count()
