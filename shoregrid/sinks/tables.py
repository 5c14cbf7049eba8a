"""Writers: partitioned appends, full refreshes, rerunnable loads and snapshots."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession

from shoregrid.operators.incremental import unseen


def append_partitioned(
    df: DataFrame, path: str, partitions: list[str], sort: list[str], mode: str = "append"
) -> None:
    """Sorted, folder-partitioned append.

    The rebalance hint gathers the rows of a partition value for large files, and splits a value
    that holds very many rows over several tasks and files.
    """
    balanced = df.hint("rebalance", *partitions)
    balanced.sortWithinPartitions(*partitions, *sort).write.mode(mode).partitionBy(
        *partitions
    ).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def create_if_missing(spark: SparkSession, name: str, schema: str, location: str) -> None:
    """Declare an empty parquet table at a location unless it exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet LOCATION '{location}'")


def refresh_full(df: DataFrame, name: str, location: str) -> None:
    """Replace a table by a fresh result."""
    df.write.mode("overwrite").option("path", location).saveAsTable(name)


def append_interval(df: DataFrame, path: str) -> None:
    """Append as is; running it twice doubles the rows. Prefer `append_new`."""
    df.write.mode("append").parquet(path)


def existing(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The table at a path, or None when nothing was written there yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_new(
    df: DataFrame,
    path: str,
    keys: list[str],
    within: Column | None = None,
    partitions: list[str] | None = None,
) -> None:
    """Append the rows whose key is not there yet, so a load can be repeated.

    `within` limits the stored rows that are compared, for instance to the loaded time range; it
    must hold for every row of `df`, and reaches the scan as partition and row-group filters.
    """
    stored = existing(df.sparkSession, path, df)
    if stored is not None:
        df = unseen(df, stored if within is None else stored.where(within), keys)
    writer = df.write.mode("append")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)


def replace_partitions(
    df: DataFrame, path: str, partitions: list[str], sort: list[str], only_present: bool = True
) -> None:
    """Write rows by partition value, sorted; replaces the partitions that the rows have, or the whole table."""
    balanced = df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *sort)
    mode = "dynamic" if only_present else "static"
    balanced.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*partitions).parquet(path)


def export_snapshot(df: DataFrame, base: str, name: str, now: datetime | None = None) -> str:
    """Full copy to a location stamped with the UTC time; returns it."""
    stamp = (now or datetime.now(UTC)).strftime("%Y%m%dT%H%M%S.%fZ")
    path = f"{base.rstrip('/')}/{name}.{stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def _folder(spark: SparkSession, path: str):
    """A path and its file system, whatever store it lies in."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path; none if there is no such path."""
    at, store = _folder(spark, path)
    if not store.exists(at):
        return []
    return sorted(f.getPath().getName() for f in store.listStatus(at) if f.isDirectory())


def folder_exists(spark: SparkSession, path: str) -> bool:
    at, store = _folder(spark, path)
    return store.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it; one that is not there is fine."""
    at, store = _folder(spark, path)
    store.delete(at, True)
