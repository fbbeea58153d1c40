"""Mergeable states: two batches equal one run, a batch run again replaces itself, compaction keeps all."""

import random
import re

import pytest
from pyspark.sql import functions as F

from revscope.operators import competitive, enrich, reviewers, sentiment, states, velocity
from revscope.operators.success import success_prediction
from revscope.plans import incremental
from tests_support import rows_equal
from fixtures import ms, product, products_df, review, reviews_df


def some_reviews(seed, n=900):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        rating = r.choice([1.0, 2.0, 3.0, 4.0, 4.5, 5.0, 4.3, None])
        when = None if r.random() < 0.02 else ms(r.randint(2019, 2021), r.randint(1, 12), r.randint(1, 28))
        user = None if r.random() < 0.02 else f"U{r.randint(0, 300)}"
        asin = None if r.random() < 0.01 else "P0" if r.random() < 0.4 else f"P{r.randint(1, 25)}"
        text = None if r.random() < 0.05 else "x" * r.randint(0, 400)
        rows.append(review(asin, rating, when, user, text, r.random() < 0.7, r.randint(0, 9)) if asin else (None, "n", user, rating, "t", text, when, True, 1))
    return rows


def some_products():
    rows = [product(f"P{k}", f"Title {k}", f"S{k % 4}" if k % 5 else None, f"${k * 7}.00") for k in range(20)]
    return rows + [product("P3", "Another title", "S9", "$1.00")]  # an id that the metadata repeats


@pytest.fixture(scope="module")
def inputs(spark):
    first, second = some_reviews(1), some_reviews(2, 400)
    return reviews_df(spark, first), reviews_df(spark, second), reviews_df(spark, first + second), products_df(spark, some_products())


def check_features(spark, folder, enriched):
    profile = competitive.competitive_analysis(enriched)
    want = {
        "sentiment_trends": sentiment.sentiment_trends(enriched),
        "competitive_analysis": profile,
        "review_velocity": velocity.velocity_analysis(enriched),
        "success_prediction": success_prediction(profile),
    }
    for name, df in want.items():
        got = spark.read.parquet(f"{folder}/{name}")
        assert got.dtypes == df.dtypes, name
        rows_equal(got, df)


def test_two_batches_equal_one_run(spark, inputs, tmp_path):
    first, second, whole, products = inputs
    target, out = str(tmp_path / "states"), str(tmp_path / "features")
    enriched = enrich.prepare(whole, products).cache()
    incremental.add_batch(spark, first, products, target, "2021-01-01", dense_reviews=50)
    rows = incremental.rebuild(spark, target, out)
    check_features(spark, out, enrich.prepare(first, products))
    incremental.add_batch(spark, second, products, target, "2021-01-02", dense_reviews=50)
    incremental.add_batch(spark, second, products, target, "2021-01-02", dense_reviews=50)  # run again: replaced, not added
    assert incremental.rebuild(spark, target, out)["sentiment_trends"] >= rows["sentiment_trends"]
    check_features(spark, out, enriched)
    summary = states.summary_from_sketches(incremental.merged(spark, target, incremental.SKETCHES)).first()
    assert summary.total_reviews == enriched.count()
    exact = enriched.agg(F.count_distinct("parent_asin").alias("p"), F.count_distinct("user_id").alias("u")).first()
    assert abs(summary.unique_products - exact.p) <= 1 and abs(summary.unique_reviewers - exact.u) <= states.DISTINCT_ERROR * exact.u
    # ids stay: each reviewer has one, whatever batch it came with
    ids = incremental.stored(spark, target, incremental.IDS)
    assert ids.count() == ids.select("user_id").distinct().count() == ids.select("reviewer").distinct().count() == exact.u
    assert incremental.compact(spark, target, "2021-01-02") == 2
    assert [r.batch for r in incremental.stored(spark, target, incremental.STATES).select("batch").distinct().collect()] == ["2021-01-02"]
    incremental.rebuild(spark, target, out)
    check_features(spark, out, enriched)
    enriched.unpersist()
    with pytest.raises(ValueError):
        incremental.add_batch(spark, first, products, target, "../x")
    with pytest.raises(ValueError):
        incremental.compact(spark, target, "2020")


def test_an_empty_batch_changes_nothing(spark, inputs, tmp_path):
    first, _, _, products = inputs
    target, out = str(tmp_path / "states"), str(tmp_path / "features")
    incremental.add_batch(spark, first, products, target, "a")
    incremental.add_batch(spark, first.limit(0), products, target, "b")
    incremental.rebuild(spark, target, out)
    check_features(spark, out, enrich.prepare(first, products))


@pytest.mark.parametrize("dense", [0, 20, 10**6])
def test_bitmaps_count_reviewers_exactly(spark, inputs, dense):
    first, second, whole, products = inputs
    one, two, both = (enrich.prepare(r, products) for r in inputs[:3])
    known = reviewers.reviewer_ids(first, runs=7)
    ids = reviewers.reviewer_ids(second, known, runs=7)
    assert known.join(ids, ["user_id", "reviewer"]).count() == known.count()  # old ids stay as they are
    assert ids.agg(F.max("reviewer")).first()[0] < 2 * ids.count()  # dense
    merged = reviewers.merge_reviewers(reviewers.reviewer_states(one, ids, dense), reviewers.reviewer_states(two, ids, dense))
    want = both.groupBy(*competitive.PRODUCT_KEYS).agg(F.count_distinct("user_id").alias("unique_reviewers")).filter("unique_reviewers > 0")
    rows_equal(reviewers.unique_reviewers(merged), want)
    if dense == 0:
        assert merged.filter("bitmap is not null and parent_asin is not null").count() > 0


def test_dense_products_ship_no_pairs(spark, inputs):
    """Bitmaps are OR-ed before the shuffle: its keys are products and buckets, not reviewers."""
    enriched = enrich.prepare(inputs[2], inputs[3])
    state = reviewers.reviewer_states(enriched, reviewers.reviewer_ids(inputs[2]), 0).filter("bitmap is not null")
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan
    keyed = [line for line in plan.splitlines() if "hashpartitioning(" in line and "bucket" in line]
    assert keyed and not any("reviewer" in line.split("hashpartitioning(")[1].split("]")[0] or "place" in line.split("hashpartitioning(")[1].split(")")[0] for line in keyed if "bitmap" in line)


def test_sketches_keep_to_their_errors(spark):
    from revscope.plans.registry import Inputs

    i = Inputs(spark, "/root/testdata/sf0.01")
    rows = {r.metric: r for r in states.sketch_accuracy(i.enriched, i.sketches).collect()}
    assert len(rows) == 6 and all(r.within for r in rows.values())
    some = states.summary_from_sketches(i.sketches, F.col("year_month") >= "1999-01-01").first()
    exact = i.enriched.filter("review_year_month >= '1999-01-01'")
    assert some.total_reviews == exact.count()
    assert abs(some.unique_products - exact.select("parent_asin").distinct().count()) <= states.DISTINCT_ERROR * some.unique_products + 1


def test_few_reviews_in_many_buckets_stay_pairs(spark):
    """40 reviewers whose ids lie in 40 buckets: 40 bitmaps of 4 kB would hold one bit each."""
    rows = [review("P1", 4.0, 10**12 + k, user=f"U{k}") for k in range(40)]
    enriched = enrich.prepare(reviews_df(spark, rows), products_df(spark, [product("P1")]))
    for apart, bitmaps in ((32_768, 0), (1, 1)):
        ids = spark.createDataFrame([(f"U{k}", 1 + k * apart) for k in range(40)], "user_id string, reviewer long")
        state = reviewers.reviewer_states(enriched, ids, 30)
        assert state.filter("bitmap is not null").count() == bitmaps
        assert reviewers.unique_reviewers(state).first().unique_reviewers == 40


def test_states_of_both_batches_are_made_in_one_pass(spark):
    """No branch a batch, and tasks of a bounded size."""
    from revscope.plans.registry import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    for made in (i.states, i.sketches):
        assert "Union" not in made._jdf.queryExecution().optimizedPlan().toString()
    rows_equal(i.states, states.merge_states(*[states.review_states(d) for d in i.days]))
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_sketches_are_asked_by_one_subquery(spark):
    from revscope.plans.registry import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    plan = states.sketch_accuracy(i.enriched, i.sketches)._jdf.queryExecution().analyzed().toString()
    assert set(re.findall(r"scalar-subquery#\d+ \[\]\.(\w+)", plan)) >= {"p25_length", "median_length", "unique_products"}


def _shuffle_keys(name, spark):
    from revscope.plans.registry import queries

    plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    return [x.split("]")[0].split("), ")[0] for x in re.findall(r"hashpartitioning\((.*)", plan)]


def test_states_are_summed_where_the_join_left_them(spark):
    """No shuffle by product and month, neither to make the states nor to merge them."""
    keys = _shuffle_keys("competitive_from_states", spark)
    assert any("_salt" in k for k in keys) and not any("year_month" in k for k in keys)


def test_pairs_are_dealt_once(spark):
    """By product and run of buckets; no shuffle by the reviewer's place, nor by bucket but for bitmaps."""
    for name in ("unique_reviewers", "competitive_from_states"):
        keys = _shuffle_keys(name, spark)
        assert any("parent_asin" in k and "run" in k for k in keys) and not any("place" in k for k in keys), keys


@pytest.mark.parametrize("buckets,dense", [(1, 20), (1, 10**6), (3, 0)])
def test_batches_in_one_pass_count_reviewers_exactly(spark, inputs, monkeypatch, buckets, dense):
    """Ids over many buckets, products with bitmaps in one batch and pairs in the other, without product, without metadata."""
    monkeypatch.setattr(reviewers, "DEALT_BUCKETS", buckets)
    reviews = inputs[0].withColumn("late", F.lit(True)).unionByName(inputs[1].withColumn("late", F.lit(False)))
    ids = reviewers.reviewer_ids(reviews, runs=7).withColumn("reviewer", F.col("reviewer") * 1000 + 1)
    asin = ["parent_asin"]
    monkeypatch.setattr(reviewers, "MOST_DENSE", 3)
    made = reviewers.reviewer_states(reviews, ids, dense, asin, ["late"])
    counted = reviewers.unique_reviewers(reviewers.merge_reviewers(made.drop("late"), keys=asin), asin)
    got = enrich.add_products(counted, inputs[3]).select(*competitive.PRODUCT_KEYS, "unique_reviewers").distinct()
    want = enrich.prepare(inputs[2], inputs[3]).groupBy(*competitive.PRODUCT_KEYS).agg(F.count_distinct("user_id").alias("unique_reviewers"))
    rows_equal(got, want.filter("unique_reviewers > 0"))


def test_stored_states_without_a_run_still_merge(spark, inputs):
    one = enrich.prepare(inputs[0], inputs[3])
    made = reviewers.reviewer_states(one, reviewers.reviewer_ids(inputs[0]), 50)
    rows_equal(reviewers.unique_reviewers(reviewers.merge_reviewers(made.drop("run"))), reviewers.unique_reviewers(made))


def test_staging_leaves_no_shuffle_files(spark, inputs):
    from revscope.plans.staging import staged

    def files():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        at = disk.getAllFiles().iterator()
        out = set()
        while at.hasNext():
            out.add(at.next().getName())
        return {f for f in out if f.startswith("shuffle_")}

    before = files()
    kept = staged(inputs[2].repartition(5, "user_id").select("parent_asin", "user_id"), "test")
    assert not files() - before
    assert kept.count() == 1300 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
