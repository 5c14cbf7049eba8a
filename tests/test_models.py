"""Models from raw files to search on hand-made inputs."""

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from shoregrid.functions import grid
from shoregrid.operators import joins
from shoregrid.plans import archives, bronze, dimensions, gold, inventory, media, registry, silver
from shoregrid.sinks import tables
from shoregrid.sources import documents, files, gridded
from shoregrid.streaming import ingest

T = datetime


def utc(*parts):
    return datetime(*parts, tzinfo=UTC)


def ntz(df, *names):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@pytest.fixture
def buoy_files(tmp_path):
    folder = tmp_path / "stdmet"
    folder.mkdir()
    (folder / "46001h2004.txt").write_text(
        "YYYY MM DD hh  WD   WSPD GST  WVHT  DPD   APD  MWD  BAR    ATMP  WTMP  DEWP  VIS  TIDE\n"
        "2004 01 01 00  45  5.5  6.0  2.00 10.00  8.00 270 1010.0 10.0 11.0 MM 99.0 99.00\n"
        "2004 01 01 01 MM  MM  6.0  99.00 10.00  8.00 MM 1010.0 10.0 11.0 MM 99.0\n"
    )
    (folder / "46001h2024.txt").write_text(
        "#YY  MM DD hh mm WDIR WSPD GST  WVHT   DPD   APD MWD   PRES  ATMP  WTMP  DEWP  VIS  TIDE\n"
        "#yr  mo dy hr mn degT m/s  m/s     m   sec   sec degT   hPa  degC  degC  degC  nmi    ft\n"
        "2024 01 01 00 75 100  5.0  6.0  1.00 10.00  8.00 180 1010.0 10.0 11.0  9.0 99.0 1.50\n"
        "2024 01 01 00 50 999  5.0  6.0  3.00 10.00  6.00 200 1010.0 10.0 11.0  9.0 99.0 99.00\n"
    )
    return str(folder)


def history(spark):
    rows = [
        ("46001", 1, T(2000, 1, 1), T(2010, 1, 1), -158.0, 21.3),
        ("46001", 2, T(2010, 1, 2), None, -157.75, 21.25),
    ]
    df = spark.createDataFrame(
        rows, "station_id string, station_sk int, s timestamp_ntz, e timestamp_ntz, lon double, lat double"
    )
    lon, lat = F.col("lon"), F.col("lat")
    return df.select(
        "station_id", "station_sk", grid.point(lon, lat).alias("geometry"), grid.cell_of(lon, lat).alias("cell"),
        F.col("s").cast("timestamp").alias("start_time"), F.col("e").cast("timestamp").alias("end_time"),
    )


def test_buoy_files_to_measurements(spark, buoy_files):
    lines = files.read_observation_text(spark, f"{buoy_files}/*.txt")
    assert lines.count() == 4
    rows = bronze.buoy_bronze(lines)
    old = bronze.buoy_bronze(lines, compat=True)
    times = lambda df: sorted(r[0] for r in df.select(F.col("timestamp_tz").cast("timestamp_ntz")).collect() if r[0])
    assert times(rows)[:2] == [T(2004, 1, 1), T(2004, 1, 1, 1)]
    assert times(old)[0] == T(2004, 1, 1, 0, 45)  # wind direction taken for the minute
    assert times(rows)[2:] == [T(2024, 1, 1), T(2024, 1, 1, 0, 50)]
    got = {
        r.timestamp_tz: r
        for r in ntz(silver.buoy_measurements(rows, history(spark)), "timestamp_tz").collect()
    }
    early, holes, late = got[T(2004, 1, 1)], got[T(2004, 1, 1, 1)], got[T(2024, 1, 1)]
    assert (early.wind_direction, early.wave_height, early.measured_wave_direction, early.station_sk) == (45, 2.0, 270, 1)
    assert (holes.wind_direction, holes.wind_speed, holes.measured_wave_direction, holes.dew_point_temp, holes.tide) == (999, 999.9, 999, 999.9, 99.0)
    assert (late.station_sk, late.tide, late.geometry.lon) == (2, 1.5, -157.75)
    former = silver.buoy_measurements(rows, history(spark), compat=True)
    assert max(r.measured_wave_direction for r in former.collect()) == 1000


def test_buoy_idw_of_one_station_in_a_cell_centre(spark, buoy_files):
    lines = files.read_observation_text(spark, f"{buoy_files}/*2024.txt")
    rows = silver.buoy_measurements(bronze.buoy_bronze(lines), history(spark))
    cell = 222 * 720 + 44
    cells = spark.createDataFrame([(cell,), (cell + 1,), (cell + 3,)], "cell long")
    got = {(r.cell, r.timestamp_tz): r for r in ntz(silver.buoy_idw(cells, rows), "timestamp_tz").collect()}
    exact = got[(cell, T(2024, 1, 1))]
    assert (exact.idw_wave_height, exact.idw_tide, exact.idw_wind_direction) == (1.0, 1.5, 100.0)
    assert got[(cell + 1, T(2024, 1, 1, 1))].idw_wave_height == 3.0
    assert {c for c, _ in got} == {cell, cell + 1}


def test_tide_files_to_measurements(spark, tmp_path):
    (tmp_path / "h001a.csv").write_text("2024,1,1,0,1500\n2024,1,1,1,-2744\n2024,1,1,2,\n")
    rows = bronze.tide_bronze(files.read_positional_csv(spark, str(tmp_path)))
    assert {(r.uh_id, r.version, r.station_id) for r in rows.collect()} == {("001", "a", "001a")}
    stations = spark.createDataFrame([("001a", -157.75, 21.25)], "station_id string, lon double, lat double").select(
        "station_id", grid.point(F.col("lon"), F.col("lat")).alias("geometry"), grid.cell_of(F.col("lon"), F.col("lat")).alias("cell")
    )
    measured = silver.tide_measurements(rows, stations, utc(2024, 1, 1), utc(2024, 1, 1, 1))
    assert measured.count() == 2
    cells = stations.select("cell")
    got = silver.tide_idw(cells, stations, silver.tide_measurements(rows, stations)).collect()
    assert [r.idw_mm for r in got] == [1500.0]


def test_wind_grid_to_measurements(spark):
    lookup = spark.createDataFrame([(-157.75, 21.25), (-157.5, 21.25)], "lon double, lat double")
    mask = lookup.select(grid.cell_of(F.col("lon"), F.col("lat")).alias("cell"))
    axes = spark.createDataFrame([([202.25, 202.4, 202.5, 10.0], [21.25, 21.25, 21.25, 21.25])], "longitude array<double>, latitude array<double>")

    def component(values, label):
        df = spark.createDataFrame([("2024010100", v) for v in [values]] , "hour string, v array<double>")
        rows = gridded.with_coordinates(gridded.unstack_grid(df, "v"), gridded.axis_rows(axes, ["longitude", "latitude"]))
        return bronze.wind_bronze(rows, mask, lookup, label)

    both = component([0.0, 0.0, 1.0, 9.0], "VAR_10U").unionByName(component([-1.0, -3.0, 0.0, 9.0], "VAR_10V"))
    got = ntz(silver.wind_measurements(both), "timestamp_tz").orderBy("cell").collect()
    assert [(round(r.wind_speed_ms, 6), round(r.wind_dir, 6)) for r in got] == [(2.0, 0.0), (1.0, 270.0)]
    assert got[0].timestamp_tz == T(2024, 1, 1)


def gold_inputs(spark):
    t = T(2024, 1, 1)
    buoys = spark.createDataFrame(
        [(1, t, 1.0, 8.0, 180.0, 90.0, 5.0, 0.5), (2, t, 1.0, 8.0, 180.0, None, None, 0.5), (3, t, 1.0, 8.0, 180.0, 90.0, 5.0, None)],
        "cell long, timestamp_tz timestamp_ntz, idw_wave_height double, idw_average_wave_period double, "
        "idw_measured_wave_direction double, idw_wind_direction double, idw_wind_speed double, idw_tide double",
    )
    wind = spark.createDataFrame([(1, t, 7.126, 45.0), (9, t, 1.0, 1.0)], "cell long, timestamp_tz timestamp_ntz, wind_speed_ms double, wind_dir double")
    tides = spark.createDataFrame([(1, t, 1234.5)], "cell long, timestamp_tz timestamp_ntz, idw_mm double")
    return buoys, wind, tides


def test_tags_need_every_feature(spark):
    got = gold.condition_tags(*gold_inputs(spark)).collect()
    assert [(r.cell, r.tag) for r in got] == [(1, [1.0, 1.0, 8.0, 180.0, 1.23, 7.13, 45.0])]


def test_photo_finds_similar_hours(spark):
    cell = 222 * 720 + 44
    rows = [
        (cell, T(2024, 1, 1, 17, 10), [float(cell), 1.0, 8.0, 180.0, 1.0, 5.0, 90.0]),
        (cell, T(2024, 1, 1, 17, 40), [float(cell), 2.0, 8.0, 180.0, 1.0, 5.0, 90.0]),
        (cell, T(2023, 5, 1), [float(cell), 2.0, 9.0, 183.0, 1.0, 5.0, 86.0]),
        (cell + 9, T(2023, 5, 2), [float(cell + 9), 2.0, 8.0, 171.0, 1.0, 5.0, 95.0]),
        (cell, T(2023, 5, 3), [float(cell), 2.0, 8.0, 190.1, 1.0, 5.0, 90.0]),
    ]
    tags = spark.createDataFrame(rows, "cell long, timestamp_tz timestamp_ntz, tag array<double>")
    photos = spark.createDataFrame(
        [("p", 157.8, "W", 21.3, "N", "2024:01:01 07:30:00", "-10:00"), ("far", 10.0, "E", 21.3, "S", "2024:01:01 07:30:00", "-10:00")],
        "photo string, gps_longitude double, gps_longitude_ref string, gps_latitude double, gps_latitude_ref string, date_time string, offset_time string",
    )
    got = {r.similar_ts: (r.matched_ts, r.l2_dist) for r in gold.similar_hours(photos, tags).collect()}
    match = T(2024, 1, 1, 17, 40)
    assert got == {
        T(2024, 1, 1, 17, 10): (match, 1.0),
        match: (match, 0.0),
        T(2023, 5, 1): (match, 5.1),
    }  # the fourth is sqrt(81 + 25) away


def test_station_xml_file(spark, tmp_path):
    path = tmp_path / "stations.xml"
    path.write_text(
        '<?xml version="1.0"?><stations>\n'
        '<station id="46001" name="A" owner="o" pgm="p" type="buoy">\n'
        '<history start="2010-01-02" stop="" lat="21.25" lng="-157.75" elev="0" met="y" hull="h" anemom_height="5"/>\n'
        '<history start="2000-01-01" stop="2010-01-01" lat="21.3" lng="-158.0" elev="" met="n" hull="h" anemom_height=""/>\n'
        "</station>\n"
        '<station id="46002" name="B" owner="o" pgm="p" type="fixed">\n'
        '<history start="1999-01-01" stop="" lat="0" lng="0" elev="1.5" met="n" hull="" anemom_height="3"/>\n'
        "</station></stations>"
    )
    rows = dimensions.station_history(documents.read_station_xml(spark, str(path)))
    got = {(r.station_id, r.station_sk): r for r in ntz(rows, "start_time", "end_time").collect()}
    assert got[("46001", 1)].end_time == T(2010, 1, 1) and got[("46001", 1)].elev is None
    assert got[("46001", 2)].end_time is None and got[("46001", 2)].cell == 222 * 720 + 44
    assert got[("46002", 1)].anemom_height == 3.0


def test_nested_table_and_missing_cells(spark):
    html = (
        "<table><tr><th>Name</th><th>Size</th></tr><tr><td>a <table><tr><td>inner</td></tr></table></td><td>1</td></tr>"
        "<tr><td>b &amp; c</td></tr></table>"
    )
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None)], "page int, html string")
    got = documents.extract_table(pages, "page", "html", ["Name", "Size"]).collect()
    assert [(r.page, r.row_no, r.Name, r.Size) for r in got] == [(1, 1, "a", "1"), (1, 2, "b & c", None)]


def test_indexes(spark):
    listing = spark.createDataFrame([("46001h2004.txt.gz",), ("Parent Directory",), ("46001h1999.txt.gz",), ("99999h2004.txt.gz",)], "name string")
    now = spark.createDataFrame([("46001current.txt", "2026-02-03 10:00")], "name string, modified string")
    known = spark.createDataFrame([("46001",)], "station_id string")
    index = archives.buoy_index(listing, now, known, "past/", "now/", "landing/")
    kept = ntz(archives.loadable(index), "timestamp_tz").collect()
    assert {(r.timestamp_tz, r.archive_url, r.s3_url) for r in kept} == {
        (T(2004, 1, 1), "past/46001h2004.txt.gz", "landing/46001h2004.txt.gz"),
        (T(2026, 1, 1), "now/46001current.txt", "landing/46001current.txt"),
    }
    keys = spark.createDataFrame(
        [("e5/200001/e5.128_165_10u.ll025sc.2000010100_2000013123.nc",), ("e5/200001/e5.128_167_2t.ll025sc.2000010100_2000013123.nc",)], "key string"
    )
    got = ntz(archives.wind_index(keys, "b/", "l/"), "start_timestamp_tz", "end_timestamp_tz").collect()
    assert [(r.start_timestamp_tz, r.end_timestamp_tz, r.s3_url) for r in got] == [
        (T(2000, 1, 1), T(2000, 1, 31, 23), "l/e5.128_165_10u.ll025sc.2000010100_2000013123.parquet")
    ]


def test_inventory_without_the_parameter_has_no_range(spark):
    xml = '<Envelope><Body><DataInventory><station ID="1"><metadata><location><lat>1</lat><long>2</long></location></metadata><parameter name="Wind" first="2001-01-01 00:00" last="2002-01-01 00:00"/></station></DataInventory></Body></Envelope>'
    row = inventory.water_level_inventory(documents.parse_inventory(spark.createDataFrame([(xml,)], "x string"), "x")).first()
    assert (row.station_id, row.geom.lon, row.time_start) == ("1", 2.0, None)


def test_known_and_unknown_spots(spark):
    names = [("clip_laniakea_20260102_0730.mp4",), ("clip_nowhere_20260102_0730.MOV",)]
    got = {r.spot: (r.taken, r.lat) for r in ntz(media.place_clips(spark.createDataFrame(names, "n string"), "n"), "taken").collect()}
    assert got == {"laniakea": (T(2026, 1, 2, 17, 30), 21.619), "nowhere": (T(2026, 1, 2, 17, 30), None)}


def test_lake_refresh_is_rerunnable(spark, tmp_path, buoy_files):
    lake = registry.Lake(spark, str(tmp_path / "lake"))
    bronze.buoy_bronze(files.read_observation_text(spark, f"{buoy_files}/*.txt")).write.parquet(lake.path("bronze/buoys"))
    history(spark).write.parquet(lake.path("bronze/station_history"))
    spark.createDataFrame([(222 * 720 + 44,)], "cell long").write.parquet(lake.path("bronze/coast_cells"))
    names = ["coast_cells", "station_history", "buoy_measurements", "buoy_idw"]
    ranges = [(utc(2004, 1, 1), utc(2004, 12, 31)), (utc(2024, 1, 1), utc(2024, 12, 31))]
    registry.refresh(lake, names, ranges)
    counts = {n: lake.table(n).count() for n in names}
    registry.refresh(lake, names, ranges)
    assert counts == {n: lake.table(n).count() for n in names}
    assert counts["buoy_measurements"] == 4 and counts["buoy_idw"] >= 2


def test_hours_at_range_edges_are_whole_and_rerunnable(spark, tmp_path):
    """23:45 and 00:15 belong to one hour, whichever of two touching ranges is refreshed, and however often."""
    lake = registry.Lake(spark, str(tmp_path / "lake"))
    spark.createDataFrame([(222 * 720 + 44,)], "cell long").write.parquet(lake.path("coast_cells"))
    place = "named_struct('lon', -157.75D, 'lat', 21.25D)"

    def reading(at, height):
        columns = {"wave_height": height, "average_wave_period": 5.0, "measured_wave_direction": 90.0, "wind_direction": 10.0, "wind_speed": 3.0, "tide": 1.0}
        parts = [f"CAST({v} AS DOUBLE) AS {k}" for k, v in columns.items()]
        return spark.range(1).selectExpr(
            "'s' AS station_id", f"TIMESTAMP '{at}' AS timestamp_tz", "1 AS station_sk", f"{place} AS geometry",
            f"{222 * 720 + 44}L AS cell", *parts,
        )

    def heights():
        rows = ntz(lake.table("buoy_idw"), "timestamp_tz").collect()
        return sorted((r.timestamp_tz, r.idw_wave_height) for r in rows)

    reading("2024-03-01 23:45:00", 1.0).unionByName(reading("2024-03-02 00:15:00", 3.0)).write.parquet(lake.path("buoy_measurements"))
    days = [(utc(2024, 3, 1), utc(2024, 3, 2)), (utc(2024, 3, 2), utc(2024, 3, 3))]
    registry.refresh(lake, ["buoy_idw"], [*days, days[0]])
    assert heights() == [(T(2024, 3, 2), 2.0)]
    reading("2024-03-02 00:20:00", 5.0).write.mode("append").parquet(lake.path("buoy_measurements"))
    registry.refresh(lake, ["buoy_idw"], [days[1]])
    assert heights() == [(T(2024, 3, 2), 3.0)]
    registry.refresh_full(lake, "buoy_idw")
    assert heights() == [(T(2024, 3, 2), 3.0)]


def test_history_join_of_long_and_open_rows(spark):
    """One key with thousands of short rows, one with overlapping open ones."""
    short = [("a", i * 10, i * 10 + 9, i) for i in range(3000)]
    held = [("b", i, None, i) for i in range(50)] + [("c", 5, 5, 1), ("c", 5, None, 2)]
    seconds = lambda c: F.timestamp_seconds(c)
    history = spark.createDataFrame(short + held, "k string, s long, e long, n long").select(
        "k", seconds("s").alias("start_time"), seconds("e").alias("end_time"), "n"
    )
    facts = spark.createDataFrame(
        [("a", 15), ("a", 29_995), ("a", 99_999), ("b", 30), ("b", 10_000), ("c", 5), ("d", 1)], "k string, at long"
    ).select("k", "at", seconds("at").alias("ts"))
    got = joins.scd_join(facts, history, "k", "ts").groupBy("k", "at").agg(F.count("n").alias("rows")).collect()
    assert {(r.k, r["at"]): r.rows for r in got} == {("a", 15): 1, ("a", 29_995): 1, ("b", 30): 31, ("b", 10_000): 50, ("c", 5): 2}


def test_points_at_the_dateline_find_their_grid_point(spark):
    from shoregrid.operators import spatial

    grid_rows = spatial.lattice(spark, 0.25).select(F.col("lon").alias("grid_lon"), F.col("lat").alias("grid_lat"))
    assert grid_rows.count() == grid_rows.distinct().count() == 1440 * 721
    points = spark.createDataFrame([(179.95, 0.0), (-179.95, 0.0)], "lon double, lat double")
    assert [r.grid_lon for r in spatial.nearest_grid(points, grid_rows, 0.25).collect()] == [-180.0, -180.0]


def test_partitioned_append_and_pruning(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    for _ in range(2):
        tables.append_partitioned(df, str(tmp_path / "t"), ["part"], ["id"])
    back = files.read_partitioned(spark, str(tmp_path / "t"), "id long, part long", "part = 1")
    assert back.count() == 666
    assert "PartitionFilters: [isnotnull(part" in back._jdf.queryExecution().toString()


def test_union_by_name_and_snapshot(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    tables.write_parquet(spark.range(1).toDF("x"), a)
    tables.write_parquet(spark.range(1).toDF("y"), b)
    assert files.read_union_by_name(spark, [a, b]).columns == ["x", "y"]
    path = tables.export_snapshot(spark.range(3), str(tmp_path), "tags", T(2026, 1, 2, 3, 4, 5))
    assert path.endswith("tags.20260102T030405.000000Z") and spark.read.parquet(path).count() == 3


def test_streams_over_several_batches_equal_batch(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(400).select(
        (F.col("id") % 7).alias("station"), (F.timestamp_seconds(F.col("id") * 600)).alias("ts"), (F.col("id") * 1.0).alias("v")
    )
    for part in range(4):
        rows.where(F.floor(F.unix_timestamp("ts") / 60000) == part).unionByName(rows.limit(5)).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: ingest.file_stream(spark, source, rows.schema, maxFilesPerTrigger="1")
    ingest.ingest_new(stream(), target, ["station", "ts"], str(tmp_path / "c1")).awaitTermination()
    assert spark.read.parquet(target).count() == 400

    hourly = str(tmp_path / "hourly")
    means = ingest.hourly_means(stream().dropDuplicates(), "station", "ts", ["v"])
    ingest.upsert_versions(means, hourly, str(tmp_path / "c2")).awaitTermination()
    got = ingest.latest_versions(spark.read.parquet(hourly), ["station", "hour"])
    from shoregrid.operators.interpolate import hourly_mean

    want = hourly_mean(rows, ["station"], "ts", {"v": ()}).select("station", F.col("ts").alias("hour"), "v")
    assert sorted(got.collect()) == sorted(want.collect())


def test_latest_and_realtime_lines(spark):
    lines = spark.createDataFrame(
        [("x/realtime2/46001.txt", ["2026", "07", "21", "10", "70", "9"])], "filename string, line array<string>"
    )
    row = ntz(ingest.realtime_rows(lines), "timestamp_tz").first()
    assert (row.station_id, row.timestamp_tz) == ("46001", T(2026, 7, 21, 10))
    latest = spark.createDataFrame([(["KXYZ", "1", "2", "2026", "07", "21", "10", "30", "5"],)], "line array<string>")
    row = ntz(ingest.latest_rows(latest), "timestamp_tz").first()
    assert (row.station_id, row.timestamp_tz) == ("KXYZ", T(2026, 7, 21, 10, 30))


def test_history_join_of_a_cluster_and_an_outlier(spark):
    """2,000 records of a second each and one decades earlier: a fact meets few of them, wherever it lies."""
    start = 1_700_000_000
    spans = [(0, "long ago", 0, 1)] + [(start + i, f"r{i}", start + i, start + i) for i in range(2000)]
    seconds = lambda c: F.timestamp_seconds(c)
    history = spark.createDataFrame(spans, "n long, name string, s long, e long").select(
        F.lit("k").alias("k"), "name", seconds("s").alias("start_time"), (seconds("e") + F.expr("INTERVAL 999999 MICROSECOND")).alias("end_time")
    )
    facts = spark.range(2000).select(F.lit("k").alias("k"), "id", (seconds(F.col("id") + start) + F.expr("INTERVAL 5 MICROSECOND")).alias("ts"))
    filed = joins.filed_by_length(history, "start_time", "end_time")
    levels = joins.levels_of(history, "start_time", "end_time")
    asked = joins.asked_by_level(facts, "ts", joins.newest_time(history, "start_time", "end_time"), levels)
    assert filed.count() <= joins.SCD_GROWTH * 2001
    met = asked.join(filed, ["k", "_level", "_cell"])
    bound = (2**joins.LEVEL_BITS + 2) * filed.select("_level").distinct().count()
    assert met.groupBy("id").count().agg(F.max("count")).first()[0] <= bound < 200
    got = joins.scd_join(facts, history, "k", "ts").collect()
    assert sorted((r.id, r.name) for r in got) == sorted((i, f"r{i}") for i in range(2000))


def test_history_join_equals_plain_join(spark):
    """Random rows: overlapping, open, empty, reversed, with missing times and keys, before 1970 too."""
    import random

    draw = random.Random(3)
    at = lambda: draw.choice([None, *[draw.randrange(-(10**e), 10**e) for e in (1, 3, 6, 9, 15)]])
    history = spark.createDataFrame([(draw.choice(["a", "b", "c", None]), at(), at(), i) for i in range(400)], "k string, s long, e long, n long")
    history = history.unionByName(history.selectExpr("k", "s", "s + n AS e", "n + 1000 AS n"))
    history = history.select("k", F.timestamp_micros("s").alias("start_time"), F.timestamp_micros("e").alias("end_time"), "n")
    facts = spark.createDataFrame([(draw.choice(["a", "b", "d", None]), at(), i) for i in range(300)], "k string, at long, id long")
    edges = history.where("n < 60").selectExpr("k", "unix_micros(coalesce(end_time, start_time)) AS at", "n + 1000 AS id")
    facts = facts.unionByName(edges).select("k", F.timestamp_micros("at").alias("ts"), "id")
    got = joins.scd_join(facts, history, "k", "ts").select("id", "n").collect()
    plain = facts.join(history, "k").where("ts BETWEEN start_time AND coalesce(end_time, ts)").select("id", "n").collect()
    assert sorted(got) == sorted(plain) and len(plain) > 1000


def test_facts_of_short_histories_are_sent_once(spark, monkeypatch):
    """Histories on several levels: facts of short ones ask once, of a long one and its bucket once a level."""
    spans = [(f"k{k}", 10 * k + at, 10 * k + at + length, i) for k in range(40) for i, (at, length) in enumerate([(0, 1), (100, 2000), (5000, 10**8)])]
    spans += [("long", i, i, i) for i in range(40)] + [("long", 0, 10**6, -1), ("long", None, 5, -2), ("k1", 9, 3, -3), ("k2", 7, None, -4)]
    seconds = lambda c: F.timestamp_seconds(c)
    history = spark.createDataFrame(spans, "k string, s long, e long, n long").select(
        "k", seconds("s").alias("start_time"), seconds("e").alias("end_time"), "n"
    )
    facts = spark.createDataFrame([(f"k{k}", 10 * k + at) for k in range(40) for at in (1, 300, 10**4, 10**9)], "k string, at long")
    facts = facts.unionByName(spark.createDataFrame([("long", 3), ("long", 10**5), (None, 5), ("none", 5), ("k3", None)], "k string, at long"))
    facts = facts.select("k", "at", seconds("at").alias("ts"))
    sent = []
    real = joins.join_dimension
    monkeypatch.setattr(joins, "join_dimension", lambda fact, *args, **named: sent.append(fact) or real(fact, *args, **named))
    plain = facts.join(history, "k").where("ts BETWEEN start_time AND coalesce(end_time, ts)").select("k", "at", "n").collect()
    found = joins.scd_join(facts, history, "k", "ts").select("k", "at", "n").collect()
    assert sorted(found) == sorted(plain) and len(plain) > 100
    times = {(r.k, r["at"]): r["count"] for r in sent[0].groupBy("k", "at").count().collect()}
    assert times["long", 3] == len(spark.range(1).select(joins.levels_of(history, "start_time", "end_time")).first()[0]) > 2
    assert sum(n > 1 for (k, _), n in times.items() if k != "long") <= 4


def test_bundles_of_raw_files_give_the_rows_of_the_files(spark, tmp_path):
    """Lines of many stations in few files, each after its file's name; files of their own still count."""
    lines = [("stdmet/%05dh%d.txt" % (i, 2024 if i % 2 else 2004), f"2024 03 0{1 + i % 9} 11 {'30 ' if i % 2 else ''}7\t{i}") for i in range(50)]
    lines += [(None, "2024 03 01 11 30 1"), ("stdmet/00001h2024.txt", "#YY MM DD"), ("stdmet/00001h2024.txt", "")]
    rows = spark.createDataFrame(lines, "filename string, value string")
    lake = registry.Lake(spark, str(tmp_path))
    files.bundled(rows.repartition(2)).write.text(lake.path("raw/buoy_bundles"))
    registry.refresh_full(lake, "bronze/buoys")
    shown = lambda: sorted((r.station_id, str(r.timestamp_tz), r.line) for r in lake.table("bronze/buoys").collect())
    named = rows.where("filename IS NOT NULL")
    want = bronze.buoy_bronze(files.observation_lines(named, "value")).collect()
    assert shown() == sorted([(r.station_id, str(r.timestamp_tz), r.line) for r in want] + [("", "2024-03-01 11:30:00", ["2024", "03", "01", "11", "30", "1"])])
    assert len(list((tmp_path / "raw" / "buoy_bundles").glob("part-*"))) <= 2
    spark.createDataFrame([("77777h2024.txt", "2024 03 01 11 30 9")], "stdmet string, value string").write.partitionBy("stdmet").text(lake.path("raw/buoys"))
    registry.refresh_full(lake, "bronze/buoys")
    assert [r[0] for r in shown()][-1] == "77777" and len(shown()) == 52


def test_rows_of_one_band_are_shared_between_tasks(spark, no_broadcast):
    """5,000 vectors in one band: the pairs of the band are made by several tasks."""
    from shoregrid.operators.search import similar_vectors

    vectors = spark.range(5000).select("id", F.array(*[F.lit(1.0)] * 6, F.col("id") / 5000.0).alias("v"))
    asked = vectors.where("id % 500 = 0").select(F.col("id").alias("q"), "v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        near = similar_vectors(asked, vectors, ["q"], "v").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in near) == 50_000 and len(near) > 2


def hour_rows(spark, sums):
    return sorted((r.station, r.hour, r.v) for r in ntz(ingest.hour_means(spark, sums, "station", ["v"]), "hour").collect())


def test_readings_of_one_hour_in_several_batches(spark, tmp_path):
    """09:35 and 10:25 belong to 10:00 whichever batch they come in; repeats and replayed batches add nothing."""
    source, store, sums, checkpoint = (str(tmp_path / n) for n in ("in", "store", "sums", "checkpoint"))
    schema = "station string, ts timestamp, v double"

    def arrive(*rows):
        spark.createDataFrame([("s", utc(*at), v) for at, v in rows], schema).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1")
        ingest.accumulate_hours(stream, store, sums, "station", "ts", ["v"], checkpoint).awaitTermination()
        return hour_rows(spark, sums)

    assert arrive(((2024, 5, 1, 9, 35), 1.0)) == [("s", T(2024, 5, 1, 10), 1.0)]
    assert arrive(((2024, 5, 1, 10, 25), 3.0)) == [("s", T(2024, 5, 1, 10), 2.0)]
    first = [("s", T(2024, 5, 1, 10), 2.0), ("s", T(2024, 5, 2, 0), 7.0)]
    assert arrive(((2024, 5, 1, 23, 40), 7.0), ((2024, 5, 1, 10, 25), 3.0)) == first
    assert arrive(((2024, 5, 1, 10, 0), None)) == first
    late = [*first[:1], ("s", T(2024, 5, 1, 11), 5.0), ("s", T(2024, 5, 2, 0), 8.0)]
    assert arrive(((2024, 5, 2, 0, 10), 9.0), ((2024, 5, 1, 10, 30), 5.0)) == late
    assert len(tables.subfolders(spark, sums)) >= 2
    days = [d for b in tables.subfolders(spark, sums) for d in tables.subfolders(spark, f"{sums}/{b}")]
    assert max(days.count(d) for d in days) == 2


def test_a_replayed_batch_writes_the_same_sums(spark, tmp_path):
    """A checkpoint that forgot the last batch, as after a failure before its commit."""
    source, store, sums, checkpoint = (str(tmp_path / n) for n in ("in", "store", "sums", "checkpoint"))
    rows = spark.range(90).select(
        (F.col("id") % 3).alias("station"), F.timestamp_seconds(F.col("id") * 700).alias("ts"), (F.col("id") * 1.0).alias("v")
    )
    for part in (2, 0, 1):
        rows.where(F.col("v") % 3 == part).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = ingest.file_stream(spark, source, rows.schema, maxFilesPerTrigger="1")
        ingest.accumulate_hours(stream, store, sums, "station", "ts", ["v"], checkpoint).awaitTermination()
        return hour_rows(spark, sums)

    want = run()
    (tmp_path / "checkpoint" / "commits" / "2").unlink()
    (tmp_path / "checkpoint" / "commits" / ".2.crc").unlink(missing_ok=True)
    assert run() == want
    hour = F.date_trunc("HOUR", F.col("ts") + F.expr("INTERVAL '30' MINUTE")).alias("hour")
    plain = ntz(rows.groupBy("station", hour).agg(F.avg("v").alias("v")), "hour").collect()
    assert want == sorted((r.station, r.hour, r.v) for r in plain)


def gauge_lake(spark, tmp_path, *times):
    lake = registry.Lake(spark, str(tmp_path / "lake"))
    place = "named_struct('lon', -157.75D, 'lat', 21.25D) AS geometry"
    spark.range(1).selectExpr("'a' AS station_id", place, "1L AS cell").write.mode("overwrite").parquet(lake.path("tide_stations"))
    rows = spark.createDataFrame([("a", utc(*t), 5 + i) for i, t in enumerate(times)], "station_id string, timestamp_tz timestamp, reading_mm long")
    rows.write.mode("overwrite").parquet(lake.path("bronze/tides"))
    return lake


def tide_times(lake):
    rows = lake.table("tide_measurements").select("timestamp_tz")
    return sorted(r.timestamp_tz for r in ntz(rows, "timestamp_tz").collect())


def test_a_day_without_readings_any_more_becomes_empty(spark, tmp_path):
    lake = gauge_lake(spark, tmp_path, (2024, 1, 1, 5), (2024, 1, 2, 5), (2024, 1, 3, 5))
    days = [(utc(2024, 1, 1), utc(2024, 1, 4))]
    registry.refresh(lake, ["tide_measurements"], days)
    gauge_lake(spark, tmp_path, (2024, 1, 1, 5), (2024, 1, 3, 6))
    registry.refresh(lake, ["tide_measurements"], [(utc(2024, 1, 2), utc(2024, 1, 3))])
    assert tide_times(lake) == [T(2024, 1, 1, 5), T(2024, 1, 3, 5)]
    registry.refresh(lake, ["tide_measurements"], days)
    assert tide_times(lake) == [T(2024, 1, 1, 5), T(2024, 1, 3, 6)]
    gauge_lake(spark, tmp_path, (2023, 1, 1, 5))
    registry.refresh(lake, ["tide_measurements"], [(utc(2024, 1, 1), utc(2024, 1, 3))])
    assert tide_times(lake) == [T(2024, 1, 3, 6)]


def test_a_load_with_repeated_keys_publishes_nothing(spark, tmp_path):
    from shoregrid.operators.audit import DuplicateKeys

    lake = gauge_lake(spark, tmp_path, (2024, 1, 1, 5), (2024, 1, 2, 5))
    days = [(utc(2024, 1, 1), utc(2024, 1, 4))]
    registry.refresh(lake, ["tide_measurements"], days)
    before = sorted(lake.table("tide_measurements").collect())
    gauge_lake(spark, tmp_path, (2024, 1, 1, 6), (2024, 1, 2, 5), (2024, 1, 2, 5))
    with pytest.raises(DuplicateKeys, match="tide_measurements"):
        registry.refresh(lake, ["tide_measurements"], days)
    with pytest.raises(DuplicateKeys):
        registry.refresh_full(lake, "tide_measurements")
    assert sorted(lake.table("tide_measurements").collect()) == before


def test_range_refresh_reads_its_days_only(spark, tmp_path):
    lake = gauge_lake(spark, tmp_path, *[(2024, 1, d, 5) for d in range(1, 20)])
    registry.refresh_full(lake, "tide_measurements")
    day = F.lit(utc(2024, 1, 4))
    rows = lake.table("tide_measurements", day - F.expr("INTERVAL '30' MINUTE"), day + F.expr("INTERVAL '1' DAY"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan and len(rows.inputFiles()) >= 1
    assert sorted(r.d for r in rows.select(F.dayofmonth("timestamp_tz").alias("d")).collect()) == [3, 4, 5]


def test_missing_days_are_found_and_filled(spark, tmp_path):
    days = [*range(1, 6), 9, 10, 20]
    lake = gauge_lake(spark, tmp_path, *[(2024, 1, d, 23, 45) for d in days], (2026, 3, 1, 0))
    assert registry.missing(lake, "tide_measurements").count() == 4
    registry.refresh(lake, ["tide_measurements"], [(utc(2024, 1, 2), utc(2024, 1, 4)), (utc(2024, 1, 20), utc(2024, 1, 21))])
    done = registry.refresh_missing(lake, ["tide_measurements"])["tide_measurements"]
    assert [(a.replace(tzinfo=None), b.replace(tzinfo=None)) for a, b in done] == [
        (T(2024, 1, 1), T(2024, 1, 2)), (T(2024, 1, 4), T(2024, 1, 6)), (T(2024, 1, 9), T(2024, 1, 11)), (T(2026, 3, 1), T(2026, 3, 2)),
    ]
    assert tide_times(lake) == [*[T(2024, 1, d, 23, 45) for d in days], T(2026, 3, 1)]
    assert registry.refresh_missing(lake, ["tide_measurements"]) == {"tide_measurements": []}
    # an hour that begins a day belongs to readings of the evening before
    spark.createDataFrame([(1,)], "cell long").write.parquet(lake.path("coast_cells"))
    ranges = [(a.day, b.day) for a, b in registry.refresh_missing(lake, ["tide_idw"])["tide_idw"]]
    assert ranges == [(2, 7), (10, 12), (21, 22), (1, 2)]


def test_index_search_reads_few_tiles_and_finds_all(spark, tmp_path):
    """A stored index: all rows within the radius, from fewer folders the smaller it is; odd values included."""
    import math
    import random

    from shoregrid.operators import vector_index

    draw = random.Random(9)
    rows = [(i, T(2024, 1, 1), [1.0, *[draw.uniform(0, 5) for _ in range(2)], draw.uniform(-400, 400), 1.0, 2.0, draw.uniform(0, 360)]) for i in range(3000)]
    rows += [(9000, T(2024, 1, 1), [1.0, 2.0, 3.0, None, 1.0, 2.0, 3.0]), (9001, T(2024, 1, 1), [1.0, None, 3.0, 5.0, 1.0, 2.0, 3.0])]
    tags = spark.createDataFrame(rows, "cell long, hour timestamp_ntz, tag array<double>")
    index = vector_index.VectorIndex(str(tmp_path / "index"), "tag")
    vector_index.build(tags, index, ["cell"])
    queries = tags.where("cell < 3").selectExpr("cell AS q", "tag")
    files = []
    for radius in (3.0, 10.0, 500.0):
        found = vector_index.similar(index, queries, ["q"], radius)
        got = {(r.q, r.cell) for r in found.collect()}
        far = lambda a, b: math.dist(a[1:], b[1:])
        want = {(q, r[0]) for q in range(3) for r in rows[:3000] if far(rows[q][2], r[2]) < radius}
        assert got == want and len(want) >= 3
        files.append(vector_index.tiles_for(index, queries, radius).count())
    assert files[0] <= files[1] < files[2] / 3
    assert vector_index.similar(index, queries.where("q < 0"), ["q"], 5.0).count() == 0
