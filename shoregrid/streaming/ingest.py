"""Near-real-time loads: latest observations, per-station catch-up, hourly means."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shoregrid.fixed_values import LATEST_LOOKBACK_STEPS, REALTIME_DAYS
from shoregrid.functions import moments, text
from shoregrid.operators.incremental import unseen
from shoregrid.operators.joins import newer_than
from shoregrid.operators.sized import join_dimension, written
from shoregrid.sources.files import COMMENT_ROW, unbundled
from shoregrid.session import work_path
from shoregrid.sinks.tables import append_new, existing, remove_folder, replace_partitions, subfolders

DAY, BATCH = "_day", "_batch"
"""Partition columns of hourly sums: the day, and the batch that wrote it last."""

LOOKBACK = f"{LATEST_LOOKBACK_STEPS * 5} minutes"


def latest_rows(lines: DataFrame) -> DataFrame:
    """Latest-observation lines: station in field 1, time in fields 4 to 8."""
    f = [text.field_at(F.col("line"), i) for i in range(1, 9)]
    return lines.withColumns({"station_id": f[0], "timestamp_tz": moments.observation_time(*f[3:8])})


def realtime_rows(lines: DataFrame, marker: str = "realtime2/") -> DataFrame:
    """Per-station realtime lines: station from the file name, time in fields 1 to 5."""
    f = [text.field_at(F.col("line"), i) for i in range(1, 6)]
    station = text.left(text.part(F.col("filename"), marker, 2), 5)
    return lines.withColumns({"station_id": station, "timestamp_tz": moments.observation_time(*f)})


def availability(now: Column, days: int = REALTIME_DAYS) -> tuple[Column, Column]:
    """First and last day for which realtime files exist, given the present time."""
    start = F.date_trunc("DAY", now - F.make_dt_interval(F.lit(days)))
    return start.alias("start_time"), F.date_trunc("DAY", now).alias("end_time")


def file_stream(spark: SparkSession, path: str, schema, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(path)


def within_lookback(stream: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Drop repeats seen within the lookback, with bounded state; `ts` must be a zoned time."""
    return stream.withWatermark(ts, LOOKBACK).dropDuplicatesWithinWatermark(keys)


def _span(batch: DataFrame, ts: str) -> Column:
    """Stored rows that can equal a row of the batch: those of its time span, and those without a time."""
    least, most = (batch.agg(f(ts)).scalar() for f in (F.min, F.max))
    return F.col(ts).between(least, most) | F.col(ts).isNull()


def ingest_new(
    stream: DataFrame, target: str, keys: list[str], checkpoint: str, ts: str | None = None, **trigger
) -> StreamingQuery:
    """Append observations not stored yet, however late they repeat.

    Each batch is compared with the stored keys, so replaying a batch after a failure adds nothing.
    If one of the keys is the time `ts`, only stored rows of the batch's time span are compared.
    """

    def load(batch: DataFrame, _: int) -> None:
        append_new(batch.distinct(), target, keys, _span(batch, ts) if ts else None)

    return _start(stream, load, checkpoint, trigger)


def text_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Lines of text files as they arrive: (filename, value)."""
    lines = spark.readStream.options(**options).text(path)
    return lines.select(F.col("_metadata.file_path").alias("filename"), "value")


def bundled_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same from bundles of many files: a file for each of very many stations costs more to make, list and open than to read."""
    return unbundled(spark.readStream.options(**options).text(path))


def judged_lines(lines: DataFrame, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Lines of (filename, value) with what `rows` makes of them and why one cannot be used (`problem`).

    Comments and blank lines are `comment`, lines without a station or a possible time `station` or `time`.
    """
    made = rows(lines.select("*", text.fields(F.col("value")).alias("line")))
    problem = (
        F.when(F.col("value").rlike(COMMENT_ROW), "comment")
        .when(F.coalesce("station_id", F.lit("")) == "", "station")
        .when(F.col("timestamp_tz").isNull(), "time")
    )
    return made.withColumn("problem", problem)


def ingest_lines(
    stream: DataFrame,
    rows: Callable[[DataFrame], DataFrame],
    target: str,
    rejected: str,
    counters: str,
    checkpoint: str,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    **trigger,
) -> StreamingQuery:
    """Append what can be read of a text feed; lines that cannot go to a side table, and all are counted.

    `rows` is `latest_rows` or `realtime_rows`; `keep` may narrow the readable ones down (as to what is newer than an
    archive). Rejected lines and counters are written under the batch's number, so a replay writes them once
    more; readable rows that are stored already are left out. Of each batch,
    read = comments + rejected + readable lines.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        judged = judged_lines(batch, rows)
        count = lambda condition, name: F.count_if(condition).alias(name)
        problem, seen = F.col("problem"), Observation(f"lines-{batch_id}")
        counted = judged.observe(
            seen,
            F.count(F.lit(1)).alias("read"),
            count(problem == "comment", "comments"),
            count(problem.isin("station", "time"), "rejected"),
            count(problem.isNull(), "readable"),
        )
        bad = counted.where(problem.isin("station", "time")).select("filename", "value", "problem")
        bad.write.mode("overwrite").parquet(f"{rejected}/{BATCH}={batch_id}")
        spark = batch.sparkSession
        numbers = spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in seen.get.items()])
        numbers.write.mode("overwrite").parquet(f"{counters}/{BATCH}={batch_id}")
        good = judged.where(problem.isNull()).select("station_id", "timestamp_tz", "line")
        good = (keep(good) if keep else good).dropDuplicates(["station_id", "timestamp_tz"])
        # asked three times below: for its first and its last time, and for its rows
        held = work_path(spark, "readable")
        good.write.parquet(held)
        good = spark.read.schema(good.schema).parquet(held)
        append_new(good, target, ["station_id", "timestamp_tz"], _span(good, "timestamp_tz"))
        remove_folder(spark, held)

    return _start(stream, load, checkpoint, trigger)


def ingest_newer(
    stream: DataFrame,
    archive: DataFrame,
    target: str,
    key: str,
    ts: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Append observations later than the archive's newest one of their station.

    The archive's newest times are worked out once, before the first batch; a batch is compared with
    the stored rows of its own time span.
    """
    newest = written(archive.groupBy(key).agg(F.max(ts).alias(ts)), "newest")

    def load(batch: DataFrame, _: int) -> None:
        append_new(newer_than(batch, newest, key, ts).distinct(), target, batch.columns, _span(batch, ts))

    return _start(stream, load, checkpoint, trigger)


def hourly_means(stream: DataFrame, station: str, ts: str, channels: list[str]) -> DataFrame:
    """Running means around each full hour; the watermark sits on the shifted time itself.

    Readings later than LOOKBACK do not count here; `accumulate_hours` takes them too.
    """
    shifted = stream.withColumn("_t", F.col(ts).cast("timestamp") + F.expr(moments.HALF_HOUR))
    return (
        shifted.withWatermark("_t", LOOKBACK)
        .groupBy(station, F.window("_t", "1 hour").alias("_w"))
        .agg(*[F.avg(c).alias(c) for c in channels])
        .select(station, F.col("_w.start").alias("hour"), *channels)
    )


def upsert_versions(stream: DataFrame, target: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each batch of updated results as one version folder; a replay overwrites its own."""

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return _start(stream, load, checkpoint, trigger, mode="update")


def accumulate_hours(
    stream: DataFrame, store: str, sums: str, station: str, ts: str, channels: list[str], checkpoint: str, **trigger
) -> StreamingQuery:
    """Sums and counts around each full hour, however late a reading comes; `hour_means` reads them.

    A batch first stores its readings that no earlier batch has, under its own number. Their sums and counts are
    added to the newest ones of the days they touch, and these days are written whole, again under the
    batch's number: only sums of touched days are read, never the readings of an hour again. All it reads is what earlier batches
    wrote, so a replayed batch writes the same once more. Of every day the last two versions are kept, as a
    replay needs the one before. No watermark drops rows.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.distinct()
        stored = existing(spark, store, rows.withColumn(BATCH, F.lit(0).cast("long")))
        if stored is not None:
            earlier = stored.where((F.col(BATCH) < batch_id) & _span(batch, ts))
            rows = unseen(rows, earlier, rows.columns)
        path = f"{store}/{BATCH}={batch_id}"
        rows.write.mode("overwrite").parquet(path)
        kept = spark.read.schema(rows.schema).parquet(path)

        hour = moments.nearest_hour(F.col(ts), dict(batch.dtypes)[ts] == "timestamp_ntz").alias("hour")
        parts = [f(c).alias(f"{name}_{c}") for c in channels for name, f in (("sum", F.sum), ("count", F.count))]
        added = kept.groupBy(station, hour).agg(*parts).withColumn(DAY, F.to_date("hour"))
        versions = existing(spark, sums, added.withColumn(BATCH, F.lit(0).cast("long")))
        merged = added
        if versions is not None:
            base = newest_versions(versions.where(F.col(BATCH) < batch_id)).drop(BATCH)
            touched = join_dimension(base, added.select(DAY).distinct(), [DAY], "left_semi", even=True)
            total = [F.sum(c).alias(c) for c in added.columns if c not in (station, "hour", DAY)]
            merged = touched.unionByName(added).groupBy(station, "hour", DAY).agg(*total)
        replace_partitions(merged, f"{sums}/{BATCH}={batch_id}", [DAY], [station, "hour"], only_present=False)
        drop_versions(spark, sums)

    return _start(stream, load, checkpoint, trigger)


def newest_versions(versions: DataFrame) -> DataFrame:
    """Of each day, the rows that the last batch wrote which touched it."""
    newest = versions.groupBy(DAY).agg(F.max(BATCH).alias(BATCH))
    return join_dimension(versions, newest, [DAY, BATCH], "left_semi", even=True)


def hour_means(spark: SparkSession, sums: str, station: str, channels: list[str]) -> DataFrame:
    """The means of what `accumulate_hours` has summed so far."""
    current = newest_versions(spark.read.parquet(sums))
    means = [F.try_divide(f"sum_{c}", f"count_{c}").alias(c) for c in channels]
    return current.select(station, "hour", *means)


def drop_versions(spark: SparkSession, sums: str, keep: int = 2) -> int:
    """Delete what is older than the last versions of a day; returns the number of folders deleted."""
    held: dict[str, list[int]] = {}
    for batch in subfolders(spark, sums):
        if batch.startswith(f"{BATCH}="):
            for day in subfolders(spark, f"{sums}/{batch}"):
                held.setdefault(day, []).append(int(batch.partition("=")[2]))
    old = [f"{sums}/{BATCH}={n}/{day}" for day, batches in held.items() for n in sorted(batches)[:-keep]]
    for path in old:
        remove_folder(spark, path)
    return len(old)


def latest_versions(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of each key."""
    rest = [c for c in versions.columns if c not in (*keys, "batch")]
    newest = versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_v"))
    return newest.select(*keys, "_v.*")


def _start(stream, load, checkpoint: str, trigger: dict, mode: str = "append") -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(load)
        .start()
    )
