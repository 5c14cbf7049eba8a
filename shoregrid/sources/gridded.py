"""Gridded arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoregrid.operators.sized import join_dimension


def unstack_grid(df: DataFrame, values: str, value: str = "value", index: str = "point") -> DataFrame:
    """One row per element of an array column, with its position from 0."""
    others = [c for c in df.columns if c != values]
    return df.select(*others, F.posexplode(values).alias(index, value))


def axis_rows(axes: DataFrame, columns: list[str], index: str = "point") -> DataFrame:
    """Parallel coordinate arrays (one row) to one row per position."""
    zipped = F.arrays_zip(*[F.col(c).alias(c) for c in columns])
    return axes.select(F.posexplode(zipped).alias(index, "_c")).select(
        index, *[F.col(f"_c.{c}").alias(c) for c in columns]
    )


def with_coordinates(rows: DataFrame, axis: DataFrame, index: str = "point") -> DataFrame:
    """Join exploded values to their coordinates by position."""
    return join_dimension(rows, axis, [index])
