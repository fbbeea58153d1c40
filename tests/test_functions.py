"""Edge rows of the scalar rules (FIXTURES §3)."""

import datetime as dt

from pyspark.sql import functions as F

from revscope.functions import dates, labels, numeric, text


def col_values(spark, values, dtype, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_sentiment_bounds(spark):
    out = col_values(spark, [4.0, 3.9, 2.1, 2.0, None, 2.5, 5.0, 1.0], "double", labels.sentiment)
    assert out == ["Positive", "Neutral", "Neutral", "Negative", "Neutral", "Neutral", "Positive", "Negative"]


def test_price_tiers(spark):
    prices = ["$19.99", "$20", "$49.99", "$50", "$100", "$1,299.00", None, "from $9", "", ".", "$0"]
    out = col_values(spark, prices, "string", lambda c: labels.price_tier(labels.price_numeric(c)))
    assert out == [
        "Budget (<$20)", "Mid ($20-50)", "Mid ($20-50)", "Premium ($50-100)", "Luxury ($100+)",
        "Luxury ($100+)", "Unknown", "Unknown", "Unknown", "Unknown", "Budget (<$20)",
    ]


def test_price_numeric_parse(spark):
    out = col_values(spark, ["$1,029.99", "$29.99", "from $12"], "string", labels.price_numeric)
    assert out == [1029.99, 29.99, None]


def test_detailed_flag(spark):
    out = col_values(spark, ["x" * 199, "x" * 200, None], "string", lambda c: labels.is_detailed(text.text_length(c)))
    assert out == [0, 1, 0]


def test_length_bands(spark):
    lengths = [49, 50, 199, 200, 499, 500, 999, 1000, None]
    out = col_values(spark, lengths, "int", labels.length_band)
    assert out == [
        "Very Short (<50)", "Short (50-200)", "Short (50-200)", "Medium (200-500)", "Medium (200-500)",
        "Long (500-1000)", "Long (500-1000)", "Very Long (1000+)", "Very Long (1000+)",
    ]


def test_trend_direction(spark):
    out = col_values(spark, [0.1, 0.101, -0.1, -0.101, None], "double", labels.trend_direction)
    assert out == ["Stable", "Improving", "Stable", "Declining", "Stable"]


def test_momentum(spark):
    pcts = [50.0, 50.01, 20.0, 20.01, -20.0, -19.99, -50.0, -49.99, None]
    out = col_values(spark, pcts, "double", labels.momentum)
    assert out == [
        "Growing", "Surging", "Stable", "Growing", "Declining", "Stable", "Collapsing", "Declining", "Collapsing",
    ]


def test_success_category(spark):
    rows = [(85.0, 5000), (85.0, 4999), (80.0, 1000), (80.0, 999), (75.0, 1), (74.99, 9000), (None, 10)]
    df = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(rows)], "i int, s double, n long")
    out = [r.c for r in df.select("i", labels.success_category("s", "n").alias("c")).orderBy("i").collect()]
    assert out == [
        "Top Performer", "Strong Performer", "Strong Performer", "Average Performer", "Average Performer",
        "Underperformer", "Underperformer",
    ]


def test_round_half_up_on_decimal_value(spark):
    out = col_values(spark, [1.005, 82.375, 83.905, 2.675, -1.005, None], "double", lambda c: numeric.round_half_up(c, 2))
    assert out == [1.01, 82.38, 83.91, 2.68, -1.01, None]


def test_milliseconds_to_utc_date(spark):
    out = col_values(spark, [1577836799999, 1577836800000], "bigint", dates.review_date)
    assert out == [dt.date(2019, 12, 31), dt.date(2020, 1, 1)]
    months = col_values(spark, [1577836799999], "bigint", lambda c: dates.year_month(dates.review_date(c)))
    assert months == [dt.date(2019, 12, 1)]


def test_store_exclusion_keeps_null(spark):
    df = spark.createDataFrame([("a", "acme basics"), ("b", "Globex"), ("c", None), ("d", "ACME")], "id string, store string")
    kept = sorted(r.id for r in df.filter(text.not_contains_ci("store", "Acme")).collect())
    assert kept == ["b", "c"]


def test_category_head_and_leaf(spark):
    df = spark.createDataFrame(
        [(0, ["a", "b"]), (1, ["a"]), (2, []), (3, None)], "i int, categories array<string>"
    )
    rows = df.select("i", text.head_element("categories").alias("h"), text.leaf_element("categories").alias("l")).orderBy("i").collect()
    assert [(r.h, r.l) for r in rows] == [("a", "b"), ("a", "a"), ("Unknown", "Unknown"), ("Unknown", "Unknown")]


def test_display_value(spark):
    from revscope.functions.display import display_value

    df = spark.createDataFrame([(1.0, None, "x"), (None, 3, None)], "a double, b int, c string")
    out = [tuple(r) for r in df.select(*[display_value(f.name, f.dataType) for f in df.schema.fields]).collect()]
    assert out == [("1.00", "NULL", "x"), ("NULL", "3", "NULL")]
