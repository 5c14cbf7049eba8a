"""Checks on finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


class DuplicateKeys(ValueError):
    """A load would store keys more than once."""


def require_unique(df: DataFrame, keys: list[str], name: str, shown: int = 5) -> None:
    """Fail, naming some of them, if keys occur more than once."""
    found = duplicates(df, keys).limit(shown).collect()
    if found:
        raise DuplicateKeys(f"{name} has more than one row for {[r.asDict() for r in found]}")
