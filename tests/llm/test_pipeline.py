"""The pipeline's defined cases, and the life of staged tables."""

import glob
import os

import corpus_pipeline
from revscope.llm import exact_dedup
from revscope.llm._common import _OPEN, shared_folder, staged, staging

FOLDER = "/root/testdata/sf0.001"
SENTENCE = "the house on the hill was built by the people of the town and they live there to this day with all of their children "


def through(spark, docs, tmp_path):
    """What each stage returns, written and read again."""
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out[name] = docs
    return out


def own_rows():
    near = [f"the {a}{b} and other {b}{a}s" for a in ("house", "town", "river", "field") for b in ("man", "land", "side", "work", "water")]
    near = " ".join(near).split()
    other = list(near)
    other[20] = "castle"
    secret = "hidden with password = hunter2hunter2 in it"
    return [
        (1, SENTENCE, "en"), (2, SENTENCE.replace(" ", "  "), "en"), (3, None, "en"), (4, "", "en"), (5, "12345 !!", "en"),
        (6, " ".join(near), "en"), (7, " ".join(other), "en"), (8, SENTENCE + secret, None), (1, SENTENCE, "en"),
        (None, "and the people of the other town live in the house by the river", "en"), (9, SENTENCE * 400 + "the very end", "en"),
    ]


def test_defined_cases_with_clashing_columns(spark, tmp_path):
    rows = [(i, t, g, "s", len(t or ""), "x", 3, "y", 5) for i, t, g in own_rows()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, N_CHARS int, family string, key int")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
        out = through(spark, docs, tmp_path)
        for name in ("language_id", "exact_dedup", "jaccard_join", "secret_scan"):
            assert out[name].columns == docs.columns
        ids = {name: sorted((r.doc_id for r in x.select("doc_id").collect()), key=lambda i: (i is None, i)) for name, x in out.items()}
        assert {3, 4, 5}.isdisjoint(ids["language_id"])  # nothing there that has a language
        kept = [i for i in ids["exact_dedup"] if i in (1, 2)]
        assert kept == [1]  # copies up to white space, and a repeated row
        assert [i for i in ids["jaccard_join"] if i in (6, 7)] == [6]
        clean = {r.doc_id: r for r in out["secret_scan"].select("doc_id", "text", "n_chars").collect()}
        assert "hunter2" not in clean[8].text and clean[8].n_chars == len(clean[8].text)
        assert set(ids["packing"]) == set(ids["secret_scan"])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_without_n_chars_and_empty(spark, empty, tmp_path):
    docs = spark.createDataFrame(own_rows(), "doc_id long, text string, lang string")
    out = through(spark, docs, tmp_path / "some")
    assert out["secret_scan"].columns == docs.columns and out["packing"].count()
    for name, frame in through(spark, empty, tmp_path / "none").items():
        assert frame.count() == 0, name


def test_results_of_other_queries_survive_the_pipeline(spark, documents):
    found = exact_dedup.exact_dedup(documents)
    before = found.count()
    corpus_pipeline.run(spark, FOLDER).count()
    assert found.count() == before == documents.count()


def test_a_block_leaves_nothing_behind(spark, documents):
    def there():
        return set(glob.glob(f"{shared_folder(spark).removeprefix('file://')}/llm/*"))

    before = there()
    with staging(spark):
        outer = staged(documents, "outer")
        with staging(spark):
            staged(documents, "inner")
            assert len(there() - before) == 2
        assert len(there() - before) == 1 and outer.count()
    assert there() == before and not _OPEN


def test_a_run_leaves_its_result_only(spark):
    folder = f"{shared_folder(spark).removeprefix('file://')}/llm"
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, FOLDER)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("pipeline-packing")
