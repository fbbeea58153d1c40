"""Classification expressions.

NULL routing follows the batch job: every ``when`` chain ends in an
``otherwise`` branch, so a NULL input lands in the last class (Neutral,
Stable, Collapsing, Very Long) except for the price tier, which tests NULL
first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the original job's output labels and bounds) ----
PRICE_TIERS = ("Unknown", "Budget (<$20)", "Mid ($20-50)", "Premium ($50-100)", "Luxury ($100+)")
PRICE_BOUNDS = (20, 50, 100)
SENTIMENTS = ("Positive", "Negative", "Neutral")
POSITIVE_MIN_RATING = 4
NEGATIVE_MAX_RATING = 2
DETAILED_MIN_LENGTH = 200
TRENDS = ("Improving", "Declining", "Stable")
TREND_THRESHOLD = 0.1
SUCCESS_CATEGORIES = ("Top Performer", "Strong Performer", "Average Performer", "Underperformer")
SUCCESS_SATISFACTION = (85, 80, 75)
SUCCESS_VOLUME = (5000, 1000)
MOMENTA = ("Surging", "Growing", "Stable", "Declining", "Collapsing")
MOMENTUM_BOUNDS = (50, 20, -20, -50)
LENGTH_BANDS = ("Very Short (<50)", "Short (50-200)", "Medium (200-500)", "Long (500-1000)", "Very Long (1000+)")
LENGTH_BOUNDS = (50, 200, 500, 1000)
PRICE_STRIP_PATTERN = "[$,]"
# ---- end of fixed values ----


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_numeric(price="price") -> Column:
    """'$1,299.00' -> 1299.0; text that is not a number -> NULL (try_cast, ANSI-safe)."""
    return F.regexp_replace(_col(price), PRICE_STRIP_PATTERN, "").try_cast("double")


def price_tier(numeric="price_numeric") -> Column:
    p = _col(numeric)
    unknown, budget, mid, premium, luxury = PRICE_TIERS
    low, middle, high = PRICE_BOUNDS
    return (
        F.when(p.isNull(), unknown)
        .when(p < low, budget)
        .when(p < middle, mid)
        .when(p < high, premium)
        .otherwise(luxury)
    )


def sentiment(rating="rating") -> Column:
    r = _col(rating)
    positive, negative, neutral = SENTIMENTS
    return (
        F.when(r >= POSITIVE_MIN_RATING, positive)
        .when(r <= NEGATIVE_MAX_RATING, negative)
        .otherwise(neutral)
    )


def is_detailed(length="review_length", min_length: int = DETAILED_MIN_LENGTH) -> Column:
    return F.when(_col(length) >= min_length, 1).otherwise(0)


def trend_direction(change="rating_change", threshold: float = TREND_THRESHOLD) -> Column:
    c = _col(change)
    improving, declining, stable = TRENDS
    return F.when(c > threshold, improving).when(c < -threshold, declining).otherwise(stable)


def success_category(
    satisfaction="satisfaction_rate",
    volume="total_reviews",
    satisfaction_bounds: tuple = SUCCESS_SATISFACTION,
    volume_bounds: tuple = SUCCESS_VOLUME,
) -> Column:
    s, n = _col(satisfaction), _col(volume)
    top, strong, average, under = SUCCESS_CATEGORIES
    s_top, s_strong, s_avg = satisfaction_bounds
    n_top, n_strong = volume_bounds
    return (
        F.when((s >= s_top) & (n >= n_top), top)
        .when((s >= s_strong) & (n >= n_strong), strong)
        .when(s >= s_avg, average)
        .otherwise(under)
    )


def momentum(change_pct="velocity_change_pct") -> Column:
    p = _col(change_pct)
    surging, growing, stable, declining, collapsing = MOMENTA
    b1, b2, b3, b4 = MOMENTUM_BOUNDS
    return (
        F.when(p > b1, surging)
        .when(p > b2, growing)
        .when(p > b3, stable)
        .when(p > b4, declining)
        .otherwise(collapsing)
    )


def length_band(length="text_length") -> Column:
    n = _col(length)
    very_short, short, medium, long_, very_long = LENGTH_BANDS
    b1, b2, b3, b4 = LENGTH_BOUNDS
    return (
        F.when(n < b1, very_short)
        .when(n < b2, short)
        .when(n < b3, medium)
        .when(n < b4, long_)
        .otherwise(very_long)
    )
