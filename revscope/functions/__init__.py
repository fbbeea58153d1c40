"""Column expressions (scalar functions) shared by the operators."""

from revscope.functions.dates import review_date, review_timestamp, year_month, span_days
from revscope.functions.numeric import round_half_up, pct, smoothed_pct
from revscope.functions.labels import (
    price_numeric,
    price_tier,
    sentiment,
    is_detailed,
    trend_direction,
    success_category,
    momentum,
    length_band,
)
from revscope.functions.text import text_length, contains_ci, not_contains_ci, head_element, leaf_element
from revscope.functions.display import display_value

__all__ = [
    "review_date",
    "review_timestamp",
    "year_month",
    "span_days",
    "round_half_up",
    "pct",
    "smoothed_pct",
    "price_numeric",
    "price_tier",
    "sentiment",
    "is_detailed",
    "trend_direction",
    "success_category",
    "momentum",
    "length_band",
    "text_length",
    "contains_ci",
    "not_contains_ci",
    "head_element",
    "leaf_element",
    "display_value",
]
