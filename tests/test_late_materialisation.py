"""Sample reviews: ranked on narrow keys, texts fetched for the chosen keys alone, result exact."""

import random

import pytest

from fixtures import review, reviews_df
from revscope.operators import theme


def brute(rows, n):
    by = {}
    for r in rows:
        if r[5] is not None:
            by.setdefault(r[0], set()).add((r[8], r[5]))
    out = {}
    for asin, texts in by.items():
        best = sorted(texts, key=lambda t: (t[0] is None, -(t[0] or 0), t[1].encode()))[:n]
        out[asin] = ("|".join(t for _, t in best), len(best))
    return out


def found(df):
    return {r.parent_asin: (r.sample_reviews, r.sample_count) for r in df.collect()}


def some_rows(seed):
    """Copies, texts that share their first characters, texts that are each other's beginning, no votes, no product."""
    r = random.Random(seed)
    same = "The same first forty characters of a text "
    rows = []
    for k in range(1500):
        asin = None if r.random() < 0.02 else f"P{r.randint(0, 12)}"
        text = r.choice([None, "", same, same + r.choice("abcdefgh"), same + "x" * r.randint(0, 30), "Ünï" * r.randint(1, 15), f"text {r.randint(0, 50)}"])
        votes = r.choice([None, 0, 0, 0, 3, r.randint(0, 40)])
        rows.append((asin, "a", f"U{k}", 4.0, "t", text, k, True, votes))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 3), (2, 1), (3, 40)])
def test_equals_ranking_whole_texts(spark, seed, n):
    rows = some_rows(seed)
    assert found(theme.sample_reviews(reviews_df(spark, rows), n)) == brute(rows, n)


def test_equal_digests_are_told_apart_by_the_text(spark, monkeypatch):
    """With a digest that says the same of all texts, nothing is lost."""
    from pyspark.sql import functions as F

    plain = theme.review_keys
    monkeypatch.setattr(theme, "review_keys", lambda df: plain(df).withColumn("text_digest", F.lit(7).cast("long")))
    rows = some_rows(4)
    assert found(theme.sample_reviews(reviews_df(spark, rows), 3)) == brute(rows, 3)


def test_no_text_is_shuffled_to_rank(spark, tmp_path):
    reviews_df(spark, [review("P1", 5.0, 1, text="a")]).write.parquet(str(tmp_path / "reviews"))
    stored = spark.read.parquet(str(tmp_path / "reviews"))
    plan = theme.sample_keys(stored, 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    assert "WindowGroupLimit" in plan and any("Partial" in x and "WindowGroupLimit" in x for x in lines)
    exchanges = [x for x in lines if "Exchange hashpartitioning" in x]
    assert exchanges and all("text_digest" in x or "parent_asin" in x for x in exchanges)
    # what the operators above the scan's projection put out, as Spark's plan states it
    assert "text" not in _names_above_projection(theme.sample_keys(stored, 3)._jdf.queryExecution().sparkPlan())
    whole = theme.sample_reviews(stored, 3)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in whole


def _names_above_projection(plan):
    """Names that a plan's nodes put out, down to the first projection of each branch."""
    out, stack = set(), [plan]
    while stack:
        at = stack.pop()
        out |= {at.output().apply(k).name() for k in range(at.output().size())}
        if not at.nodeName().startswith("Project"):
            stack += [at.children().apply(k) for k in range(at.children().size())]
    return out


def _shuffled_bytes(df):
    """Bytes that the exchanges of a collected frame's final plan wrote, as Spark's own metrics state them."""
    stack, found = [df._jdf.queryExecution().executedPlan()], 0
    while stack:
        at = stack.pop()
        name = at.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(at.finalPhysicalPlan())
        elif name.endswith("QueryStage"):
            stack.append(at.plan())
        else:
            found += at.metrics().apply("dataSize").value() if name == "Exchange" else 0
            stack += [at.children().apply(k) for k in range(at.children().size())]
    return found


def test_a_text_is_not_shuffled_for_each_review(spark, tmp_path):
    """8,000 reviews share 4 texts of 2,000 characters; 400 products show one each: 0.8 MB of the 16 MB move, beside keys."""
    rows = [(f"P{k % 400}", "a", f"U{k}", 4.0, "t", str(k % 4) + "x" * 2000, k, True, k // 400) for k in range(8000)]
    reviews_df(spark, rows).write.parquet(str(tmp_path / "reviews"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = theme.sample_reviews(spark.read.parquet(str(tmp_path / "reviews")), 1)
        got = out.collect()
        assert {r.parent_asin: (r.sample_reviews, r.sample_count) for r in got} == brute(rows, 1)
        assert _shuffled_bytes(out) < 5_000_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_feedback_ranks_reviews_of_matching_products_alone(spark):
    """With raw reviews the answer is the same, and no text passes the enrichment join."""
    from fixtures import product, products_df
    from revscope.operators import enrich, questions

    reviews = reviews_df(spark, some_rows(5))
    enriched = enrich.prepare(reviews, products_df(spark, [product(f"P{k}", title=f"ring {k}" if k % 2 else "other") for k in range(13)]))
    plain = questions.feedback_for_product(enriched, "ring", 3)
    asked = questions.feedback_for_product(enriched, "ring", 3, reviews)
    key = lambda r: r.parent_asin
    assert sorted(plain.collect(), key=key) == sorted(asked.collect(), key=key) and asked.count() == 6


def test_the_longest_text_is_not_moved(spark, tmp_path):
    """200 products show a text of 20,000 characters and one of 20: each text is shuffled as a distinct one, the long ones no more."""
    rows = [(f"P{k}", "a", f"U{k}", 4.0, "t", t, k, True, 1) for k in range(200) for t in (str(k % 10) + "x" * 20_000, f"{k % 7} a short text")]
    reviews_df(spark, rows).write.parquet(str(tmp_path / "reviews"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = theme.sample_reviews(spark.read.parquet(str(tmp_path / "reviews")), 2)
        assert {r.parent_asin: (r.sample_reviews, r.sample_count) for r in out.collect()} == brute(rows, 2)
        assert _shuffled_bytes(out) < 2_000_000  # 4 MB if each product is sent its long text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("anchored", [0, 3, 10**6])
def test_staged_samples_equal_ranking_whole_texts(spark, monkeypatch, anchored):
    """With staging, and where a longest text has more products than go to it."""
    from revscope.plans.staging import staged

    monkeypatch.setattr(theme, "MOST_ANCHORED", anchored)
    rows = some_rows(6)
    assert found(theme.sample_reviews(reviews_df(spark, rows), 3, stage=staged)) == brute(rows, 3)


def test_staged_samples_with_equal_digests(spark, monkeypatch):
    from pyspark.sql import functions as F

    from revscope.plans.staging import staged

    plain = theme.review_keys
    monkeypatch.setattr(theme, "review_keys", lambda df: plain(df).withColumn("text_digest", F.lit(7).cast("long")))
    rows = some_rows(7)
    assert found(theme.sample_reviews(reviews_df(spark, rows), 3, stage=staged)) == brute(rows, 3)


def test_feedback_is_the_same_with_staging(spark):
    from fixtures import product, products_df
    from revscope.operators import enrich, questions
    from revscope.plans.staging import staged

    reviews = reviews_df(spark, some_rows(8))
    enriched = enrich.prepare(reviews, products_df(spark, [product(f"P{k}", title=f"ring {k}" if k % 2 else "other") for k in range(13)]))
    key = lambda r: r.parent_asin
    plain, kept = (questions.feedback_for_product(enriched, "ring", 3, reviews, s).collect() for s in (None, staged))
    assert sorted(plain, key=key) == sorted(kept, key=key) and len(kept) == 6


def test_registered_samples_shuffle_no_reviews_at_their_end(spark):
    """The reviews were ranked and their texts found before: what is left reads staged tables, not the source."""
    from revscope.plans.registry import queries

    for name in ("sample_reviews", "feedback_for_product"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "revscope-sample-texts" in plan and "lineitem.parquet" not in plan, name
