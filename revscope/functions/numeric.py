"""Numeric helpers.

All published ratios and averages are rounded HALF_UP on their decimal value:
the double is cast to ``decimal(28,10)`` before ``round`` and cast back, so a
value printed as ``1.005`` rounds to ``1.01`` and exact ties such as
``82.375`` round up, whatever the engine's binary representation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int = 2) -> Column:
    return F.round(_col(c).cast("decimal(28,10)"), scale).cast("double")


def pct(part, whole, scale: int | None = 2) -> Column:
    """``part / whole * 100``; rounded unless ``scale`` is None; NULL where ``whole`` is 0."""
    raw = F.try_divide(_col(part), _col(whole)) * 100
    return raw if scale is None else round_half_up(raw, scale)


def smoothed_pct(current, previous, scale: int = 2) -> Column:
    """``(current - previous) / (previous + 1) * 100`` — the +1 avoids a zero divisor."""
    cur, prev = _col(current), _col(previous)
    return round_half_up((cur - prev) / (prev + 1) * 100, scale)
