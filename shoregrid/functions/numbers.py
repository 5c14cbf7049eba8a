"""Rounding and number parsing with the semantics the measurements need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"


def round_half_away(x: Column, digits: int = 2) -> Column:
    """Round the binary value half away from zero.

    The built-in rounds the shortest decimal text, so 1.005 would become 1.01 although the double
    is below the tie; scaling first decides on the binary value. ``x`` appears only once, which
    keeps generated code short.
    """
    scale = float(10**digits)
    return F.round(x * scale, 0) / scale


def to_int_half_even(x: Column) -> Column:
    """Double to int by rounding half to even (a plain cast truncates)."""
    return F.rint(x).cast("int")


def parse_double(text: Column) -> Column:
    """Number or NULL; only decimal notation counts (the cast alone would take ``1d`` or ``2f``).

    A plain number stays one with ``e0`` behind it, while all else the cast would take does not;
    the pattern is needed only for what is left, such as numbers that have an exponent already.
    """
    plain = F.concat(text, F.lit("e0")).try_cast("double")
    return F.coalesce(plain, F.when(text.rlike(_NUMBER), text.try_cast("double")))


def to_int_half_away(x: Column) -> Column:
    """Double to int by rounding half away from zero; NULL when out of range."""
    return F.round(x, 0).try_cast("int")


def parse_int(text: Column) -> Column:
    """Integer or NULL; fractions round half away from zero instead of failing."""
    return to_int_half_away(parse_double(text))


def parse_double_or(text: Column, default: float) -> Column:
    return F.coalesce(parse_double(text), F.lit(float(default)))


def parse_int_or(text: Column, default: int) -> Column:
    return F.coalesce(parse_int(text), F.lit(default))


def sentinel_to_null(value: Column, *sentinels: float) -> Column:
    """NULL where the value is one of the missing-value markers."""
    keep = F.lit(True)
    for marker in sentinels:
        keep = keep & (value != F.lit(marker))
    return F.when(keep, value)
