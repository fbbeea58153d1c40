"""Streaming velocity equals the batch table, late reviews included."""

import datetime as dt

from pyspark.sql import functions as F

from revscope.operators.enrich import prepare
from revscope.operators.velocity import velocity_analysis
from revscope.plans.registry import Inputs
from revscope.streaming.velocity import compact, read_review_stream, read_velocity, start_velocity_stream
from tools.compare_oracle import rows_of

SF = "/root/testdata/sf0.001"


def run(stream, folder):
    query = start_velocity_stream(stream, str(folder / "velocity"), str(folder / "chk"), available_now=True)
    query.awaitTermination(300)
    assert query.exception() is None


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def test_stream_equals_batch(spark, tmp_path):
    i = Inputs(spark, SF)
    src = tmp_path / "incoming"
    years = i.reviews.withColumn("y", F.year(F.timestamp_millis("timestamp")))
    # one file a year, the years in no order: most reviews arrive late
    for (y,) in years.select("y").distinct().orderBy(F.desc("y")).collect():
        years.filter(F.col("y") == y).drop("y").coalesce(1).write.mode("append").parquet(str(src))
    run(read_review_stream(spark, str(src), max_files_per_trigger=1), tmp_path)
    got = read_velocity(spark, str(tmp_path / "velocity"), i.products)
    assert rows(got) == rows(i.velocity)
    compact(spark, str(tmp_path / "velocity"), str(tmp_path / "compacted"))
    assert rows(read_velocity(spark, str(tmp_path / "compacted"), i.products)) == rows(i.velocity)


def test_late_january_reviews_count(spark, tmp_path):
    i = Inputs(spark, SF)
    ms = lambda *d: int(dt.datetime(*d, tzinfo=dt.UTC).timestamp() * 1000)
    template = i.reviews.limit(1)
    src = tmp_path / "incoming"
    sent = [ms(2020, 1, 3), ms(2020, 1, 30), ms(2020, 2, 1), ms(2020, 1, 31), ms(2020, 4, 1), ms(2020, 1, 5)]
    for t in sent:
        one = template.withColumn("timestamp", F.lit(t)).withColumn("parent_asin", F.lit("P7"))
        one.coalesce(1).write.mode("append").parquet(str(src))
    run(read_review_stream(spark, str(src), max_files_per_trigger=1), tmp_path)
    got = {r.year_month: r.monthly_reviews for r in read_velocity(spark, str(tmp_path / "velocity"), i.products).collect()}
    assert got == {dt.date(2020, 1, 1): 4, dt.date(2020, 2, 1): 1, dt.date(2020, 4, 1): 1}
    past = read_velocity(spark, str(tmp_path / "velocity"), i.products, before="2020-02-01").collect()
    assert [r.monthly_reviews for r in past] == [4]
    batch = velocity_analysis(prepare(spark.read.parquet(str(src)), i.products))
    assert rows(read_velocity(spark, str(tmp_path / "velocity"), i.products)) == rows(batch)
