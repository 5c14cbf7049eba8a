"""Array, JSON and vector expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_lists(element_type: str, *lists: Column) -> Column:
    """Concatenate lists; a NULL list counts as empty."""
    empty = F.array().cast(f"array<{element_type}>")
    return F.concat(*[F.coalesce(x, empty) for x in lists])


def slice_from(values: Column, first: int) -> Column:
    """Elements first.. (counted from 1) to the end."""
    return F.slice(values, first, F.greatest(F.size(values) - (first - 1), F.lit(0)))


def first_match(values: Column, test: Callable[[Column], Column]) -> Column:
    """First element that passes the test, or NULL."""
    return F.get(F.filter(values, test), 0)


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays, summed in element order."""
    terms = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(terms, F.lit(0.0), lambda total, t: total + t))


def l2_distance_unrolled(pairs: list[tuple[Column, Column]]) -> Column:
    """Same for a fixed number of dimensions held as columns; stays inside generated code."""
    total = F.lit(0.0)
    for x, y in pairs:
        total = total + (x - y) * (x - y)
    return F.sqrt(total)
