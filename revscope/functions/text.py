"""String and array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_length(text="text") -> Column:
    """Length in characters; NULL text -> NULL."""
    return F.length(_col(text))


def contains_ci(c, needle: str) -> Column:
    """Case-insensitive substring test; NULL input -> NULL."""
    return F.lower(_col(c)).contains(needle.lower())


def not_contains_ci(c, needle: str) -> Column:
    """Keep rows whose value does not contain ``needle`` (any case); NULL is kept."""
    return ~F.coalesce(contains_ci(c, needle), F.lit(False))


def head_element(arr="categories") -> Column:
    """First element, 'Unknown' for NULL or empty arrays."""
    a = _col(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) >= 1, F.element_at(a, 1)).otherwise(F.lit(UNKNOWN))


def leaf_element(arr="categories") -> Column:
    """Most specific (last) element, 'Unknown' for NULL or empty arrays."""
    a = _col(arr)
    return F.when(F.coalesce(F.size(a), F.lit(0)) >= 1, F.element_at(a, -1)).otherwise(F.lit(UNKNOWN))


def shorten(c, width: int = 100) -> Column:
    """Display cut: first ``width`` characters plus '...' when longer."""
    s = _col(c)
    return F.when(F.length(s) > width, F.concat(F.substring(s, 1, width), F.lit("..."))).otherwise(s)
