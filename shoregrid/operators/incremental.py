"""What is still to be loaded, and how to split it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shoregrid.fixed_values import WORK_BUCKETS
from shoregrid.functions.moments import year_slices
from shoregrid.operators.sized import join_dimension


def unseen(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target; a missing key column equals a missing one.

    Keys identify rows, so they are not counted first.
    """
    return join_dimension(df, target.select(*keys).distinct(), keys, "left_anti", even=True, null_safe=True)


def pending(
    index: DataFrame, landed: DataFrame, on: list[str], mentions: tuple[str, str] | None = None
) -> DataFrame:
    """Index rows nothing has landed for yet.

    `mentions=(url, label)` adds the condition that the index column `url` contains the landed
    column `label` as a pattern, so that two files of one time are told apart.
    """
    residual = None
    columns = on
    if mentions:
        url, label = mentions
        residual = F.regexp_like(url, F.col(label))
        columns = [*on, label]
    return join_dimension(index, landed.select(*columns).distinct(), on, "left_anti", residual)


def pending_grain(
    index: DataFrame, landed: DataFrame, index_grain: Column, landed_grain: Column
) -> DataFrame:
    """Same at a coarser grain, such as the month."""
    done = landed.select(landed_grain.alias("_grain")).distinct()
    return join_dimension(index.withColumn("_grain", index_grain), done, ["_grain"], "left_anti").drop(
        "_grain"
    )


def in_manifest(df: DataFrame, manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Rows named in a manifest; a semi join, so the manifest may be of any length."""
    return join_dimension(df, manifest.select(*keys).distinct(), keys, "left_semi")


def work_buckets(df: DataFrame, key: str, n: int = WORK_BUCKETS) -> DataFrame:
    """Spread work over n buckets by the first half of the key's MD5, the same way on every run and engine."""
    number = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 8), 16, 10).cast("long")
    return df.withColumn("bucket", F.pmod(number, F.lit(n)).cast("int"))


def yearly_intervals(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """One row per year-long slice of each range."""
    sliced = ranges.withColumn("_slice", F.explode(year_slices(F.col(start), F.col(end))))
    return sliced.select(*ranges.columns, "_slice.slice_start", "_slice.slice_end")


def missing_ranges(wanted: DataFrame, held: DataFrame, day: str) -> DataFrame:
    """(slice_start, slice_end) of the runs of days that are wanted and not held: gaps and islands.

    Ends are the midnight after a run's last day; a run is cut into slices of a year. Both tables hold one row per
    calendar day, so the numbering window is short however large the tables behind them are.
    """
    gaps = wanted.select(day).where(F.col(day).isNotNull()).join(held.select(day), day, "left_anti").distinct()
    island = F.date_sub(F.col(day), F.row_number().over(Window.orderBy(day)))
    runs = gaps.withColumn("_island", island).groupBy("_island").agg(
        F.min(day).cast("timestamp").alias("range_start"), F.date_add(F.max(day), 1).cast("timestamp").alias("range_end")
    )
    return yearly_intervals(runs, "range_start", "range_end").select("slice_start", "slice_end")
