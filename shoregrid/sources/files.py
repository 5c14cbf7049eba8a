"""File readers. Schemas are declared; nothing is inferred by reading data twice."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.functions import text

BUOY_INDEX = "timestamp_tz timestamp, station_id string, archive_url string, s3_url string"
TIDE_INDEX = "uh_id string, version string, archive_url string, s3_url string"
WIND_INDEX = (
    "start_timestamp_tz timestamp, end_timestamp_tz timestamp, archive_url string, s3_url string"
)
POSITIONAL = "year int, month int, day int, hour int, reading_mm long"

LISTED_ROWS = 10_000
"""Files of one batch of a listing."""
_LISTED = pa.schema(
    [("path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("folder", pa.bool_())]
)

ARCHIVE_ROW = r"^\s*[0-9]"
"""Archive files: headers start with letters or '#', observations with the year."""
COMMENT_ROW = r"^\s*(#|$)"
"""Latest-observation files: comments start with '#'; station ids may start with a letter."""


def read_archive_index(spark: SparkSession, path: str, schema: str = BUOY_INDEX) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_observation_text(
    spark: SparkSession, paths: str | list[str], latest: bool = False
) -> DataFrame:
    """Observation lines as (filename, line array), without comments and headers.

    Lines are kept or dropped by their own look, so large files can be split between tasks.
    """
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("filename"), "value")
    return observation_lines(raw, "value", latest)


def bundled(lines: DataFrame) -> DataFrame:
    """Lines of many small files, (filename, value), as text for few large ones: each after the name of its file and a tab."""
    return lines.select(F.concat(F.coalesce("filename", F.lit("")), F.lit("\t"), "value").alias("value"))


def read_bundled_text(spark: SparkSession, paths: str | list[str], latest: bool = False) -> DataFrame:
    """Observation lines as `read_observation_text` gives them, from bundles of many files.

    A folder or file for each of very many stations costs more to make, list and open than to read.
    """
    return observation_lines(unbundled(spark.read.text(paths)), "value", latest)


def unbundled(lines: DataFrame) -> DataFrame:
    """What `bundled` was given: (filename, value)."""
    name = F.substring_index("value", "\t", 1)
    return lines.select(name.alias("filename"), F.substr("value", F.length(name) + 2).alias("value"))


def observation_lines(df: DataFrame, value: str, latest: bool = False) -> DataFrame:
    row = F.col(value)
    keep = ~row.rlike(COMMENT_ROW) if latest else row.rlike(ARCHIVE_ROW)
    return df.where(keep).withColumn("line", text.fields(row)).drop(value)


def read_positional_csv(
    spark: SparkSession, paths: str | list[str], schema: str = POSITIONAL
) -> DataFrame:
    """Headerless columns by position, with the source file name."""
    rows = spark.read.schema(schema).csv(paths, header=False)
    return rows.select(F.col("_metadata.file_path").alias("filename"), "*")


def read_partitioned(
    spark: SparkSession, base: str, schema: str | None = None, where: Column | str | None = None
) -> DataFrame:
    """Partitioned parquet; a condition on partition columns prunes folders before reading."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(base)
    return df if where is None else df.where(where)


def read_union_by_name(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files whose columns differ: missing ones are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def list_files(spark: SparkSession, base: str, pattern: str = "*", levels: int = 2) -> DataFrame:
    """File listing as a table (path, modified, length); file contents are not read.

    Tasks do the listing: the driver holds the base folder only. Each of the first `levels` levels of folders is
    dealt out anew, so that the folders found there are spread over all tasks; what lies deeper is walked
    folder by folder by the task that was dealt its parent. Every folder is listed once. Names that start with a
    dot or an underscore are left out, save partition folders. `pattern` (`*`, `?`, `[...]`) is matched with the
    file's name. An empty folder gives no rows, a missing one fails. Tasks list through `pyarrow.fs`.
    """
    scheme, mark, _ = base.partition("://")
    local = not mark
    root = base.removeprefix("file:") if local else base
    reached = f"s3{mark}{base[len(scheme) + len(mark) :]}" if scheme in ("s3a", "s3n") else root

    def lister(deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, start = fs.FileSystem.from_uri(reached)
            start = start.rstrip("/")

            def children(folder: str) -> list[dict]:
                found = []
                for info in system.get_file_info(fs.FileSelector(start + folder)):
                    name = info.base_name
                    if name.startswith(".") or (name.startswith("_") and "=" not in name):
                        continue
                    row = {"path": f"{folder}/{name}", "modified": None, "length": None, "folder": True}
                    if info.type == fs.FileType.File:
                        if not fnmatch.fnmatchcase(name, pattern):
                            continue
                        row |= {"modified": info.mtime, "length": info.size, "folder": False}
                    found.append(row)
                return found

            for batch in batches:
                waiting = []
                for row in batch.to_pylist():
                    if row["folder"]:
                        waiting.append(row["path"])
                    else:
                        yield pa.RecordBatch.from_pylist([row], schema=_LISTED)
                while waiting:
                    found = children(waiting.pop())
                    if deep:
                        waiting += [r["path"] for r in found if r["folder"]]
                        found = [r for r in found if not r["folder"]]
                    for at in range(0, len(found), LISTED_ROWS):
                        yield pa.RecordBatch.from_pylist(found[at : at + LISTED_ROWS], schema=_LISTED)

        return run

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    schema = "path string, modified timestamp, length long, folder boolean"
    rows = spark.range(1).select(
        F.lit("").alias("path"), F.lit(None).cast("timestamp").alias("modified"),
        F.lit(None).cast("long").alias("length"), F.lit(True).alias("folder"),
    )
    for level in range(levels + 1):
        if level:  # with a number, so that adaptive execution does not merge few small rows into one task
            rows = rows.repartition(tasks, "path")
        rows = rows.mapInArrow(lister(level == levels), schema)
    shown = ("file:" if local else "") + root.rstrip("/")
    return rows.select(F.concat(F.lit(shown), "path").alias("path"), "modified", "length")


def landed_partitions(files: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct partition values found in listed paths."""
    return files.select(*[text.path_value(F.col("path"), k).alias(k) for k in keys]).distinct()
