"""Text expressions: slices from either end, list parts, first-match replacement."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = "[ \\t\\n\\f\\r]+"


def left(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def between_positions(text: Column, first: int, last: int) -> Column:
    """Characters first..last, both included, counted from 1."""
    return F.substring(text, first, last - first + 1)


def tail_slice(text: Column, first: int, last: int) -> Column:
    """Characters counted from the end: -1 is the last one; both ends included."""
    return F.substring(text, first, last - first + 1)


def part(text: Column, separator: str, n: int) -> Column:
    """n-th part (from 1, or from -1 at the end) of a literally separated text; '' when missing."""
    return F.split_part(text, F.lit(separator), F.lit(n))


def replace_first(text: Column, pattern: str, replacement: str) -> Column:
    """Replace only the first match (the built-in replaces all)."""
    return F.regexp_replace(text, f"(?s)^(.*?)(?:{pattern})", "$1" + re.sub(r"([\\$])", r"\\\1", replacement))


def fields(line: Column) -> Column:
    """Blank-separated fields of a text line; a leading blank gives a leading empty field."""
    return F.split(F.regexp_replace(line, BLANKS, ","), ",")


def field_at(line: Column, position: Column | int) -> Column:
    """Field at a position counted from 1, which may be computed per row; NULL outside the line."""
    at = F.lit(position) if isinstance(position, int) else position
    return F.get(line, at - 1)


def unquote(text: Column) -> Column:
    return F.replace(text, F.lit('"'), F.lit(""))


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros; longer values stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def path_value(path: Column, key: str) -> Column:
    """Value of a ``key=value`` folder in a path, URL-decoded; NULL when the path has none."""
    pattern = f"(?:^|/){re.escape(key)}=([^/]*)"
    return F.when(path.rlike(pattern), F.try_url_decode(F.regexp_extract(path, pattern, 1)))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))
