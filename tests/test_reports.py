"""Reports, sampling and windows that are checked by rows or properties."""

from pyspark.sql import functions as F

from revscope.operators import conversations, profile, reports
from revscope.plans.registry import Inputs

SF = "/root/testdata/sf0.001"


def test_random_sample_is_repeatable(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    a = reports.random_sample(df, 0.1, 42)
    b = reports.random_sample(df, 0.1, 42)
    assert a.count() == b.count() and 300 < a.count() < 900


def test_peek_cuts_text_and_counts_arrays(spark):
    df = spark.createDataFrame([("x" * 150, ["a", "b", "c"], 1)], "t string, arr array<string>, n int")
    row = reports.peek(df, 1, width=100).first()
    assert row.t == "x" * 100 + "..." and row.arr == "3 items" and row.n == 1


def test_last_turns_keeps_newest(spark):
    df = spark.createDataFrame([(1, t, "user", f"m{t}") for t in range(1, 11)] + [(2, 1, "user", "only")],
                               "conv_id long, turn long, role string, text string")
    out = conversations.last_turns(df, 8)
    assert sorted(r.turn for r in out.filter("conv_id = 1").collect()) == list(range(3, 11))
    assert out.filter("conv_id = 2").count() == 1


def test_approximate_distinct_within_tolerance(spark):
    i = Inputs(spark, "/root/testdata/sf0.01")
    exact = profile.product_summary(i.reviews).first().unique_products
    approx = profile.product_summary(i.reviews, exact=False).first().unique_products
    assert abs(approx - exact) <= 0.1 * exact


def test_approximate_percentiles_close_to_exact(spark):
    i = Inputs(spark, SF)
    exact = profile.text_stats(i.reviews).first()
    approx = profile.text_stats(i.reviews, exact=False).first()
    for k in ("p25_length", "median_length", "p75_length"):
        assert abs(getattr(exact, k) - getattr(approx, k)) <= 0.05 * getattr(exact, k)


def test_declining_report_null_first_and_skip_option(spark):
    i = Inputs(spark, SF)
    plain = reports.declining(i.velocity, 5).collect()
    assert plain[0].velocity_change_pct is None and plain[0].momentum == "Collapsing"
    useful = reports.declining(i.velocity, 5, skip_first_month=True).collect()
    assert all(r.velocity_change_pct is not None for r in useful)
    pcts = [r.velocity_change_pct for r in useful]
    assert pcts == sorted(pcts)


def test_sample_reviews_bounded_and_whole(spark):
    i = Inputs(spark, SF)
    out = i.enriched
    from revscope.operators.theme import sample_reviews

    s = sample_reviews(out, 3)
    assert s.filter(F.col("sample_count") > 3).count() == 0
    # whole texts: each sample is its product's texts, joined
    texts = {}
    for r in out.filter("text is not null").select("parent_asin", "text").distinct().collect():
        texts.setdefault(r.parent_asin, set()).add(r.text)
    for r in s.collect():
        own = texts[r.parent_asin]
        assert r.sample_count == min(3, len(own))
        assert any(r.sample_reviews.startswith(t) for t in own) and any(r.sample_reviews.endswith(t) for t in own)
        assert min(map(len, own)) * r.sample_count <= len(r.sample_reviews) <= sum(sorted(map(len, own))[-3:]) + 2
