"""Joins that stay fast whether the smaller side fits in memory or not, and whether keys are even or not.

`join_dimension` broadcasts its second input only when the planner's size estimate is below the
session's broadcast limit. Beyond it, rows of keys with a million rows or more are spread over one
task per million rows (the matching dimension rows are repeated as often, all others are not), so one
key holding a third of the fact rows does not end in one task. The table of such keys has at most
one row per million fact rows, which is what makes it safe to broadcast.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoregrid.session import work_path

HOT_ROWS = 1_000_000
"""A key is hot from this many rows on: there is at most one hot key per million rows."""

_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes (negative: never broadcast)."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    match = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", text)
    return int(match[1]) * _UNITS[match[2].lower()]


def plan_bytes(df: DataFrame) -> int | None:
    """The planner's size estimate, or None where the client cannot see it."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
    except AttributeError:
        return None
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame, growth: int = 1) -> bool:
    """Is the estimate, times the growth the planner does not see (explode), below the limit?"""
    size = plan_bytes(df)
    return size is not None and size * growth <= broadcast_limit(df.sparkSession)


def settled(df: DataFrame, name: str, growth: int = 1) -> DataFrame:
    """The frame itself if it is known to fit a broadcast, else a copy written to the shared folder.

    Estimates of aggregates and joins are far above the truth; the written copy has its real size,
    so the check made on it afterwards is a check of real bytes. It also cuts lineage.
    """
    return df if fits_broadcast(df, growth) else written(df, name)


def written(df: DataFrame, name: str) -> DataFrame:
    """A copy in the shared folder, for results that several later steps read."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """The rows in tasks of about so many each, for costly work per row on tables in few or small files."""
    return df.repartition(max(1, -(-df.count() // rows)))


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys of at least `rows` rows with `_ways`, the tasks that they are worth (one for each so many rows).

    Found in one pass over the key columns with map-side counts.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    ways = (F.ceil(F.col("_rows") / rows) + 1).cast("int").alias("_ways")
    return counts.where(F.col("_rows") >= rows).select(*keys, ways)


def spread(df: DataFrame, ways: Column) -> Column:
    """Spread value per row: by content, and by input partition so that copies part as well.

    It does not depend on row order, so a task that is run again assigns the same values.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")])
    return F.pmod(content + F.spark_partition_id(), ways).cast("int")


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "inner",
    residual: Column | None = None,
    growth: int = 1,
    even: bool = False,
    null_safe: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi join of a large with a usually smaller side; `how` is inner, left, left_semi or left_anti.

    `residual` is a further condition over columns of both sides, whose other names must differ.
    `even=True` says that keys hardly repeat in `fact` or that it is costly to compute: it is then
    not counted beforehand, and partitions that turn out large are split by the adaptive skew join.
    A `dim` with `growth` that does not fit is never broadcast: the planner, at run time too, sees it before it grows.
    `null_safe=True` lets a missing key equal a missing key; it needs `even`.
    """
    fact_cols = fact.columns
    sorted_side = (lambda d: d.hint("merge")) if growth > 1 else (lambda d: d)
    if fits_broadcast(dim, growth):
        left, right, keys = fact, dim, on
        wrap = F.broadcast
    elif even:
        left, right, keys = fact, dim, on
        wrap = sorted_side
    else:
        ways = max(2, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
        hot = F.broadcast(hot_keys(fact, on, hot_rows))
        lost = functools.reduce(operator.or_, [F.col(k).isNull() for k in on])
        left = (
            fact.join(hot, on, "left")
            .withColumn(
                "_salt",
                F.when(F.col("_ways").isNotNull() | lost, spread(fact, F.coalesce("_ways", F.lit(ways)))).otherwise(
                    F.lit(0)
                ),
            )
            .drop("_ways")
        )
        right = (
            dim.join(hot, on, "left")
            .withColumn(
                "_salt",
                F.explode(
                    F.when(F.col("_ways").isNotNull(), F.sequence(F.lit(0), F.col("_ways") - 1)).otherwise(
                        F.array(F.lit(0))
                    )
                ),
            )
            .drop("_ways")
        )
        keys = [*on, "_salt"]
        wrap = sorted_side
    renamed = right.withColumnsRenamed({k: f"_dim_{k}" for k in keys})
    equal = Column.eqNullSafe if null_safe else Column.__eq__
    condition = functools.reduce(operator.and_, [equal(F.col(k), F.col(f"_dim_{k}")) for k in keys])
    if residual is not None:
        condition = condition & residual
    joined = left.join(wrap(renamed), condition, how)
    extra = [] if how in ("left_semi", "left_anti") else [c for c in dim.columns if c not in on]
    return joined.select(*fact_cols, *extra)
