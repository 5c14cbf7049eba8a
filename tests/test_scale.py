"""Plans and batches that keep their shape as tables grow."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shoregrid.operators.sized import dealt, join_dimension
from shoregrid.queries import scans, streams
from shoregrid.sources.files import bundled
from shoregrid.streaming import ingest


def test_a_side_that_grows_is_not_broadcast(spark, tmp_path):
    path = str(tmp_path / "few")
    spark.range(60_000).select("id", F.rand(1).alias("x")).write.parquet(path)
    dim = spark.read.parquet(path).withColumn("k", F.explode(F.sequence(F.col("id"), F.col("id") + 40)))
    fact = spark.range(1000).withColumnRenamed("id", "k")
    for even in (True, False):
        joined = join_dimension(fact, dim, ["k"], growth=41, even=even)
        assert joined.count() == sum(min(k, 40) + 1 for k in range(1000))
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [k" in plan.split("Initial Plan")[0]


def test_pages_are_dealt_to_tasks_by_their_number(spark, tmp_path, monkeypatch):
    assert dealt(spark.range(25).coalesce(1), 10).rdd.getNumPartitions() == 3
    parts = spark.range(20).selectExpr(
        "id AS p_partkey", "'a' AS p_name", "'b' AS p_brand", "'t' AS p_type", "CAST(1 AS INT) AS p_size", "1D AS p_retailprice"
    )
    parts.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(scans, "PAGES_A_TASK", 5)
    found = scans.html_tables(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == 4
    assert found.count() == 40


@pytest.fixture
def feed(spark, tmp_path, monkeypatch):
    """Events of 12 stations, each in all four parts; where the feed's folders lie is noted."""
    at = lambda n: datetime(2024, 1, 13) + timedelta(minutes=7 * n)
    rows = [(n, at(n), n // 4, "view", float(n), "") for n in range(48)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    seen, fed = {}, streams._fed

    def noted(spark, target, rejected, counters, station):
        seen["counters"] = spark.read.parquet(counters)
        return fed(spark, target, rejected, counters, station)

    monkeypatch.setattr(streams, "_fed", noted)
    return str(tmp_path), seen


def test_realtime_feed_is_taken_in_part_by_part(spark, feed):
    path, seen = feed
    rows = streams.realtime_feed(spark, path).collect()
    assert len(rows) == 12 and all(r.lines_read == r.lines_kept for r in rows)
    assert sorted(r["_batch"] for r in seen["counters"].collect()) == [0, 1, 2, 3]


def test_realtime_feed_lands_in_few_files_however_many_stations(spark, feed, monkeypatch):
    path, _ = feed
    work_path = streams.work_path
    monkeypatch.setattr(streams, "work_path", lambda s, n: f"{path}/feed" if n == "feed" else work_path(s, n))
    assert len(streams.realtime_feed(spark, path).collect()) == 12
    assert len([f for f in Path(path, "feed").glob("**/*.txt") if f.is_file()]) == 4


def test_bundled_lines_stream_as_they_were(spark, tmp_path):
    rows = [("realtime2/00001.txt", "2024 01 02 03 04  a\tb"), ("realtime2/00002.txt", ""), ("realtime2/00002.txt", "#c")]
    bundled(spark.createDataFrame(rows, "filename string, value string")).write.text(str(tmp_path / "in"))
    stream = ingest.bundled_stream(spark, str(tmp_path / "in"))
    checkpoint = str(tmp_path / "checkpoint")
    to = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet")
    to.start(str(tmp_path / "out")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(rows)


def test_parts_of_the_latest_feed_have_several_files(spark, feed, monkeypatch):
    path, seen = feed
    monkeypatch.setattr(streams, "FILE_LINES", 4)
    made = []
    text_stream = streams.ingest.text_stream
    monkeypatch.setattr(streams.ingest, "text_stream", lambda s, p, **o: made.append(p) or text_stream(s, p, **o))
    rows = streams.latest_feed(spark, path).collect()
    assert len(rows) == 12 and all(r.lines_read == r.lines_kept for r in rows)
    assert sorted(r["_batch"] for r in seen["counters"].collect()) == [0, 1, 2, 3]
    files = spark.read.text(made[0]).select(F.input_file_name()).distinct().count()
    assert files == 12
