"""Named models over a folder of tables: refresh one in full, or for one time range."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.functions.moments import nearest_hour
from shoregrid.operators.audit import require_unique
from shoregrid.operators.incremental import missing_ranges
from shoregrid.plans import bronze, gold, silver
from shoregrid.session import work_path
from shoregrid.sinks.tables import folder_exists, remove_folder, replace_partitions
from shoregrid.sources.files import read_bundled_text, read_observation_text, read_positional_csv


@dataclass(frozen=True)
class Lake:
    """Tables as parquet folders below one base path."""

    spark: SparkSession
    base: str

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def table(self, name: str, start=None, end=None) -> DataFrame:
        """A table without its day column; of one laid out by day, the days from `start` to `end` are read."""
        rows = self.spark.read.parquet(self.path(name))
        if DAY not in rows.columns:
            return rows
        day = F.col(DAY)
        if start is not None:
            rows = rows.where(day >= F.to_date(F.lit(start)))
        if end is not None:
            rows = rows.where(day <= F.to_date(F.lit(end)))
        return rows.drop(DAY)


@dataclass(frozen=True)
class Model:
    """How to build a table; with keys it can be built for a time range, from inputs `halo` beyond both ends.

    Hourly models take each reading to its nearest hour, so they need half an hour more of readings. `source` names
    the table and its time column whose days the model should have. Keys must be unique in what is published.
    """

    build: Callable[[Lake, object, object], DataFrame]
    keys: tuple[str, ...] = ()
    ts: str = "timestamp_tz"
    halo: str = "INTERVAL '0' MINUTE"
    source: tuple[str, str] | None = None
    partitions: tuple[str, ...] = ()

    @property
    def incremental(self) -> bool:
        return bool(self.keys)


HALF_HOUR = "INTERVAL '30' MINUTE"
DAY = "_day"
"""Partition column of the tables that are refreshed by time range."""


def _copy(source: str, lake: Lake, start, end) -> DataFrame:
    return lake.table(source)


def _raw_buoys(lake: Lake, start, end) -> DataFrame:
    """Text files `stdmet/<name>.txt`, folders `stdmet=<name>.txt` of parts, and bundles of many such files."""
    files, bundles = lake.path("raw/buoys"), lake.path("raw/buoy_bundles")
    landed = []
    if folder_exists(lake.spark, bundles):
        landed.append(read_bundled_text(lake.spark, bundles))
    if not landed or folder_exists(lake.spark, files):
        landed.append(read_observation_text(lake.spark, files))
    lines = reduce(DataFrame.unionByName, landed)
    lines = lines.withColumn("filename", F.replace("filename", F.lit("stdmet="), F.lit("stdmet/")))
    return bronze.buoy_bronze(lines).withColumn("year", F.year("year"))


def _raw_tides(lake: Lake, start, end) -> DataFrame:
    """CSV files `<number><version>.csv`, or folders `gauge=<number><version>.csv` of parts."""
    rows = read_positional_csv(lake.spark, lake.path("raw/tides"))
    name = F.regexp_extract("filename", r"([^/=]+\.csv)", 1)
    return bronze.tide_bronze(rows.withColumn("filename", name))


def _raw_wind(lake: Lake, start, end) -> DataFrame:
    gridded = lake.table("raw/wind")
    mask, lookup = lake.table("coast_cells"), lake.table("wind_lookup")
    parts = [
        bronze.wind_bronze(gridded.where(F.col("component") == c), mask, lookup, c) for c in ("VAR_10U", "VAR_10V")
    ]
    return parts[0].unionByName(parts[1])


def _buoy_measurements(lake: Lake, start, end) -> DataFrame:
    return silver.buoy_measurements(
        lake.table("bronze/buoys"), lake.table("station_history"), start, end
    )


def _tide_measurements(lake: Lake, start, end) -> DataFrame:
    return silver.tide_measurements(
        lake.table("bronze/tides"), lake.table("tide_stations"), start, end
    )


def _wind(lake: Lake, start, end) -> DataFrame:
    return silver.wind_measurements(lake.table("bronze/wind"), start, end)


def _tide_idw(lake: Lake, start, end) -> DataFrame:
    return silver.tide_idw(
        lake.table("coast_cells"),
        lake.table("tide_stations"),
        lake.table("tide_measurements", start, end),
        start,
        end,
    )


def _buoy_idw(lake: Lake, start, end) -> DataFrame:
    return silver.buoy_idw(lake.table("coast_cells"), lake.table("buoy_measurements", start, end), start, end)


def _tags(lake: Lake, start, end) -> DataFrame:
    inputs = [lake.table(name, start, end) for name in ("buoy_idw", "wind", "tide_idw")]
    return gold.condition_tags(*inputs, start, end)


MODELS: dict[str, Model] = {
    "coast_cells": Model(partial(_copy, "bronze/coast_cells")),
    "coast_shapes": Model(partial(_copy, "bronze/coast_shapes")),
    "wind_lookup": Model(partial(_copy, "bronze/wind_lookup")),
    "station_history": Model(partial(_copy, "bronze/station_history")),
    "tide_stations": Model(partial(_copy, "bronze/tide_stations")),
    "bronze/buoys": Model(_raw_buoys, partitions=("year",)),
    "bronze/tides": Model(_raw_tides),
    "bronze/wind": Model(_raw_wind, partitions=("wind_dim",)),
    "buoy_measurements": Model(
        _buoy_measurements, ("station_id", "timestamp_tz", "station_sk"), source=("bronze/buoys", "timestamp_tz")
    ),
    "tide_measurements": Model(
        _tide_measurements, ("station_id", "timestamp_tz"), source=("bronze/tides", "timestamp_tz")
    ),
    "wind": Model(_wind, ("cell", "timestamp_tz"), source=("bronze/wind", "utc_date")),
    "tide_idw": Model(
        _tide_idw, ("cell", "timestamp_tz"), halo=HALF_HOUR, source=("tide_measurements", "timestamp_tz")
    ),
    "buoy_idw": Model(
        _buoy_idw, ("cell", "timestamp_tz"), halo=HALF_HOUR, source=("buoy_measurements", "timestamp_tz")
    ),
    "tags": Model(_tags, ("cell", "timestamp_tz"), source=("buoy_idw", "timestamp_tz")),
}
"""In an order in which every model comes after the ones it reads."""


def _staged(lake: Lake, name: str, rows: DataFrame) -> tuple[DataFrame, str]:
    """Rows of a model by day in a staging folder, and that folder; fails if keys repeat in them.

    What is published stays as it was: the check comes before anything of it is replaced.
    """
    model = MODELS[name]
    path = work_path(lake.spark, f"staged-{name.replace('/', '-')}")
    dated = rows.withColumn(DAY, F.to_date(model.ts))
    replace_partitions(dated, path, [DAY], list(model.keys), False)
    staged = lake.spark.read.schema(dated.schema).parquet(path)
    try:
        require_unique(staged, [*model.keys], name)
    except ValueError:
        remove_folder(lake.spark, path)
        raise
    return staged, path


def refresh_full(lake: Lake, name: str) -> None:
    """Rebuild a whole table; one that can be refreshed by range is staged, checked and laid out by day."""
    model = MODELS[name]
    rows = model.build(lake, None, None)
    if model.incremental:
        staged, path = _staged(lake, name, rows)
        replace_partitions(staged, lake.path(name), [DAY], list(model.keys), False)
        remove_folder(lake.spark, path)
    elif model.partitions:
        replace_partitions(rows, lake.path(name), list(model.partitions), [], False)
    else:
        rows.write.mode("overwrite").parquet(lake.path(name))


def refresh_interval(lake: Lake, name: str, start, end) -> None:
    """Build the days from that of `start` up to that of `end` (left out if `end` is midnight) and replace them all.

    Whole days are built, from inputs a little beyond both ends, and only rows inside are kept, so touching ranges
    fit together, a range can be repeated, and late or corrected readings change what was stored. The days are
    staged and checked before any is published; a day for which nothing is built any more is taken out.
    """
    model = MODELS[name]
    day = F.expr("INTERVAL '1' DAY")
    first = F.date_trunc("DAY", F.lit(start))
    last = F.date_trunc("DAY", F.lit(end))
    last = F.when(last == F.lit(end), last).otherwise(last + day)
    halo = F.expr(model.halo)
    rows = model.build(lake, first - halo, last + halo)
    staged, path = _staged(lake, name, rows.where((F.col(model.ts) >= first) & (F.col(model.ts) < last)))
    emptied = published_days(lake, name).where((F.col(DAY) >= F.to_date(first)) & (F.col(DAY) < F.to_date(last)))
    gone = [r[DAY] for r in emptied.join(staged.select(DAY).distinct(), DAY, "left_anti").collect()]
    replace_partitions(staged, lake.path(name), [DAY], list(model.keys))
    for old in gone:
        remove_folder(lake.spark, f"{lake.path(name)}/{DAY}={old}")
    remove_folder(lake.spark, path)


def published_days(lake: Lake, name: str) -> DataFrame:
    """The days that a table has; as many rows as calendar days, whatever it holds."""
    try:
        rows = lake.spark.read.parquet(lake.path(name))
    except AnalysisException as err:
        if err.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return lake.spark.range(0).select(F.current_date().alias(DAY))
    day = F.col(DAY) if DAY in rows.columns else F.to_date(MODELS[name].ts)
    return rows.select(day.alias(DAY)).distinct()


def missing(lake: Lake, name: str) -> DataFrame:
    """(slice_start, slice_end): ranges of days that a model's source has rows for and the model has not, a year long at most."""
    model = MODELS[name]
    source, ts = model.source
    at = nearest_hour(F.col(ts), False) if model.halo == HALF_HOUR else F.col(ts)
    wanted = lake.table(source).select(F.to_date(at).alias(DAY)).distinct()
    return missing_ranges(wanted, published_days(lake, name), DAY)


def refresh_missing(lake: Lake, names: list[str]) -> dict[str, list[tuple]]:
    """Refresh exactly what is missing, model by model; returns the ranges. Their number is bounded by calendar days."""
    done = {}
    for name in names:
        found = missing(lake, name).orderBy("slice_start").collect()
        done[name] = [(r.slice_start, r.slice_end) for r in found]
        for start, end in done[name]:
            refresh_interval(lake, name, start, end)
    return done


def refresh(lake: Lake, names: list[str], ranges: list[tuple]) -> None:
    """Run models for all ranges: full ones once, the others range by range."""
    for name in names:
        if not MODELS[name].incremental:
            refresh_full(lake, name)
            continue
        for start, end in ranges:
            refresh_interval(lake, name, start, end)
