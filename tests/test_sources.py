"""Sources and sinks: round trips in temporary folders."""

import datetime as dt
import json

from pyspark.sql import functions as F

from revscope.schemas import REVIEW_VELOCITY, SUCCESS_PREDICTION
from revscope.sources import readers, writers


def test_read_reviews_json_and_gzip(spark, tmp_path):
    import gzip

    recs = [
        {"parent_asin": "P1", "asin": "P1a", "user_id": "U7", "rating": 4.0, "title": "ok", "text": "works",
         "timestamp": 1577836800000, "verified_purchase": True, "helpful_vote": 2},
        {"parent_asin": "P2", "rating": 1.0, "timestamp": 1577836799999},
    ]
    path = tmp_path / "reviews.jsonl.gz"
    with gzip.open(path, "wt") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    df = readers.read_reviews(spark, str(path), min_partitions=4)
    assert df.rdd.getNumPartitions() >= 4
    rows = {r.parent_asin: r for r in df.collect()}
    assert rows["P1"].helpful_vote == 2 and rows["P1"].verified_purchase is True
    assert rows["P2"].text is None


def test_tolerant_products_and_load_errors(spark, tmp_path):
    from revscope.operators.quality import load_errors

    path = tmp_path / "meta.jsonl"
    path.write_text(
        json.dumps({"parent_asin": "P1", "title": "Widget", "price": "$1,029.99", "categories": ["a", "b"],
                    "rating_number": 12, "average_rating": 4.1}) + "\n" + '{"parent_asin":\n'
    )
    df = readers.read_products_tolerant(spark, str(path)).cache()
    assert df.count() == 2
    errors = load_errors(df).collect()
    assert len(errors) == 1 and errors[0]._corrupt_record.startswith('{"parent_asin":')
    good = df.filter(F.col("_corrupt_record").isNull()).first()
    assert good.categories == ["a", "b"] and good.rating_number == 12
    df.unpersist()


def test_feature_csv_round_trip_with_quotes(spark, tmp_path):
    rows = [("B010", 'Tablet with stand, 7" Display', "Acme", 81.74, "Average Performer", 77.35, 1.29, 95.13, 18.04, 6.15),
            ("B075", "Plain", None, None, "Underperformer", 10.0, None, 50.0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, SUCCESS_PREDICTION)
    src, dst = tmp_path / "pq", tmp_path / "csv"
    assert writers.write_feature(df, str(src)) == 2
    assert writers.export_csv(spark, str(src), str(dst), single_file=True) == 2
    back = readers.read_feature_csv(spark, str(dst), SUCCESS_PREDICTION)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    text = "".join(p.read_text() for p in dst.glob("*.csv"))
    assert '"Tablet with stand, 7"" Display"' in text


def test_export_all_reports_failures(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "x int")
    writers.write_all({"a": df}, str(tmp_path / "src"))
    status = {r.table_name: r for r in writers.export_all_csv(spark, str(tmp_path / "src"), str(tmp_path / "dst"), ["a", "missing"]).collect()}
    assert status["a"].status == "OK" and status["a"].rows == 1
    assert status["missing"].status == "FAILED"


def test_staged_promotion(spark, tmp_path):
    path = tmp_path / "staged.csv"
    cols = [f.name for f in REVIEW_VELOCITY.fields]
    path.write_text(
        ",".join(cols) + "\n"
        + 'P1,"Title, with comma",S1,2020-01-01,3,4.5,1.0,2.0,100.0,Surging\n'
        + "P1,T,S1,2020-02-01,1,4.0,,.,,Collapsing\n"
        + "P2,T,S1,2020-02-01,1,4.0,0.0,0.0,-50.0,Collapsing\n"
    )
    staged = readers.stage_strings(spark, str(path), cols)
    assert staged.filter(F.col("prev_month_reviews").isNull()).count() == 1
    typed = readers.promote_staged(staged, REVIEW_VELOCITY)
    rows = {(r.parent_asin, r.year_month): r for r in typed.collect()}
    first = rows[("P1", dt.date(2020, 1, 1))]
    assert first.prev_month_reviews == 1 and first.velocity_change == 2 and first.product_title == "Title, with comma"
    gap = rows[("P1", dt.date(2020, 2, 1))]
    assert gap.prev_month_reviews is None and gap.velocity_change is None and gap.velocity_change_pct is None
    assert rows[("P2", dt.date(2020, 2, 1))].prev_month_reviews == 0


def test_bucketed_feature_table_and_views(spark, tmp_path):
    from revscope.plans.ask import ask_sql, format_result

    rows = [("S1", dt.date(2020, 1, 1), 3, 4.333, 2, 1, 0, 66.67, 33.33, None, "Stable")]
    from revscope.schemas import SENTIMENT_TRENDS

    df = spark.createDataFrame(rows, SENTIMENT_TRENDS)
    writers.create_feature_table(df, "sentiment_trends", buckets=4, path=str(tmp_path / "tbl"))
    typed = spark.table("sentiment_trends")
    assert dict(typed.dtypes)["avg_rating"] == "decimal(10,2)"
    assert dict(typed.dtypes)["review_count"] == "int"
    assert float(typed.first().avg_rating) == 4.33
    writers.external_table(spark, "ext_trends", str(tmp_path / "tbl"))
    out = ask_sql(spark, {"agg_sentiment_trends": df}, "SELECT store, review_count FROM agg_sentiment_trends")
    assert [tuple(r) for r in out.collect()] == [("S1", 3)]
    res = format_result(ask_sql(spark, {"agg_sentiment_trends": df}, "SELECT store, avg_rating, rating_change FROM agg_sentiment_trends"))
    assert res["row_count"] == 1
    assert res["data"] == "Results:\nstore | avg_rating | rating_change\nS1 | 4.33 | NULL\n"
    empty = format_result(ask_sql(spark, {"agg_sentiment_trends": df}, "SELECT * FROM agg_sentiment_trends WHERE 1 = 0"))
    assert empty == {"success": True, "row_count": 0, "data": "No results found"}


def test_input_files_lists_sizes(spark):
    files = readers.input_files(spark, "/root/testdata/sf0.001", "*.parquet")
    names = {r.path.rsplit("/", 1)[-1] for r in files.collect()}
    assert {"lineitem.parquet", "part.parquet"} <= names
    total = readers.input_totals(files).first()
    assert total.files == len(names) and total.total_bytes > 0
    assert "content" not in files.columns


def test_read_parts_unions_by_name(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([(2,)], "x int").write.parquet(str(tmp_path / "p2"))
    out = readers.read_parts(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "a"), (2, None)]


def test_column_catalog_and_required_columns(spark):
    from revscope.schemas import column_catalog, require_columns

    df = spark.createDataFrame([(1, "a")], "rating int, text string")
    cat = column_catalog(spark, {"reviews": df}).collect()
    assert [(r.column_name, r.data_type, r.ordinal_position) for r in cat] == [("rating", "int", 1), ("text", "string", 2)]
    req = {r.column_name: r.present for r in require_columns(spark, df, {"rating": "trends", "asin": "linking"}).collect()}
    assert req == {"rating": True, "asin": False}


def test_sample_csv_and_replace_table(spark, tmp_path):
    df = spark.range(0, 50).selectExpr("id", "cast(id % 7 as string) as k")
    writers.export_sample_csv(df, str(tmp_path / "sample"), n=10, order_by=["id"])
    back = spark.read.option("header", True).csv(str(tmp_path / "sample"))
    assert back.count() == 10 and sorted(int(r.id) for r in back.collect()) == list(range(10))
    writers.replace_table(spark, "replaced_view", df)
    writers.replace_table(spark, "replaced_view", df.limit(3))
    assert spark.table("replaced_view").count() == 3
    writers.replace_table(spark, "replaced_tbl", df, temporary=False)
    writers.replace_table(spark, "replaced_tbl", df.filter("id < 5"), temporary=False)
    assert spark.table("replaced_tbl").count() == 5


def test_create_all_feature_tables(spark, tmp_path):
    from revscope.plans.registry import Inputs

    i = Inputs(spark, "/root/testdata/sf0.001")
    names = writers.create_feature_tables(
        {"sentiment_trends": i.trends, "review_velocity": i.velocity}, buckets=4, base_path=str(tmp_path / "tables")
    )
    assert names == ["sentiment_trends", "review_velocity"]
    assert spark.table("review_velocity").count() == i.velocity.count()
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED review_velocity").collect()}
    assert "parent_asin" in detail.get("Bucket Columns", "")


def test_checkpoint_dir_comes_from_the_session(spark):
    from revscope.session import ensure_checkpoint_dir

    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_ask_sql_accepts_queries_only(spark):
    import pytest

    from revscope.plans.ask import ask_sql

    df = spark.createDataFrame([(1,)], "x int")
    assert ask_sql(spark, {"t_ro": df}, "-- note\n  WITH a AS (SELECT x FROM t_ro) SELECT * FROM a").count() == 1
    assert ask_sql(spark, {"t_ro": df}, "/* c */ (SELECT x FROM t_ro)").count() == 1
    for bad in ("DROP TABLE t_ro", "INSERT INTO t_ro VALUES (2)", "CREATE TABLE z AS SELECT 1"):
        with pytest.raises(ValueError):
            ask_sql(spark, {"t_ro": df}, bad)


def test_tolerant_read_falls_back_when_inference_fails(spark, tmp_path):
    path = tmp_path / "dup.jsonl"
    path.write_text('{"parent_asin": "P1", "title": "A", "details": {"Color": "red", "color": "blue"}}\n')
    ok = tmp_path / "ok.jsonl"
    ok.write_text('{"parent_asin": "P2", "title": "B", "extra": 1}\n')
    inferred = readers.read_products_tolerant(spark, str(ok), infer=True)
    assert "extra" in inferred.columns
    fallback = readers.read_products_tolerant(spark, str(path), infer=True)
    assert "details" in fallback.columns and "_corrupt_record" in fallback.columns
    assert fallback.select("parent_asin").first().parent_asin == "P1"


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    import pytest
    from pyspark.sql.types import StringType, StructField, StructType

    (tmp_path / "t.csv").write_text("store,parent_asin,extra\nS1,P1,x\n")
    schema = StructType([StructField(c, StringType()) for c in ("parent_asin", "store")])
    assert [tuple(r) for r in readers.read_feature_csv(spark, str(tmp_path / "t.csv"), schema).collect()] == [("P1", "S1")]
    assert [tuple(r) for r in readers.stage_strings(spark, str(tmp_path / "t.csv"), ["parent_asin", "store"]).collect()] == [("P1", "S1")]
    with pytest.raises(ValueError):
        readers.read_feature_csv(spark, str(tmp_path / "t.csv"), StructType([StructField("absent", StringType())]))


def test_failed_export_keeps_the_whole_message(spark, tmp_path):
    status = writers.export_all_csv(spark, str(tmp_path), str(tmp_path / "csv"), ["no_such_table"]).first()
    assert status.status == "FAILED" and "no_such_table" in status.error and not status.error.endswith("...")


def test_requested_column_that_is_absent_is_reported(spark):
    from revscope.operators.profile import completeness

    rows = {r.column_name: r for r in completeness(spark.createDataFrame([(1,), (None,)], "a int"), ["a", "b"]).collect()}
    assert rows["a"].completeness_pct == 50.0 and rows["b"].status == "MISSING" and rows["b"].non_null_count is None


def test_empty_inputs_give_nulls(spark):
    from revscope.operators.enrich import match_rate
    from revscope.operators.profile import completeness, product_summary

    none = spark.createDataFrame([], "parent_asin string, title string")
    assert match_rate(none, none).first().match_rate_pct is None
    assert product_summary(none).first().avg_reviews_per_product is None
    assert completeness(none).first().completeness_pct is None


def test_only_queries_are_accepted(spark):
    import pytest

    from revscope.plans.ask import ask_sql, is_query

    for sql in ("SELECT 1", "WITH a AS (SELECT 1 AS x) SELECT * FROM a", "VALUES (1)", "/* c */ (SELECT 1) UNION (SELECT 2)", "FROM range(3) SELECT id"):
        assert is_query(spark, sql), sql
    for sql in ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "FROM (SELECT 1) INSERT INTO t SELECT *", "CREATE TABLE t AS SELECT 1", "DROP TABLE t", "SET x = 1"):
        with pytest.raises(ValueError):
            ask_sql(spark, {}, sql)
