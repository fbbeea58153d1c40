"""Tiny in-memory review and product frames for unit tests."""

import datetime as dt

from revscope.schemas import PRODUCTS, REVIEWS

DAY_MS = 86_400_000


def ms(y, m, d, hour=12):
    return int(dt.datetime(y, m, d, hour, tzinfo=dt.timezone.utc).timestamp() * 1000)


def review(asin, rating, when, user="U1", text="nice product", verified=True, votes=0, title="t"):
    return (asin, asin + "-a", user, rating, title, text, when, verified, votes)


def product(asin, title="Widget", store="S1", price="$10.00", category="Audio"):
    return (asin, title, category, store, price, [], [], 4.0, 100)


def reviews_df(spark, rows):
    return spark.createDataFrame(rows, REVIEWS)


def products_df(spark, rows):
    return spark.createDataFrame(rows, PRODUCTS)
