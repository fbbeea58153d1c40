"""Corpus pipeline: documents that reject no language, exact copy, near copy or secret, packed.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written and read again as the next one's docs.
All but the last keep the columns of documents.

1. language_id: documents in no learned language go (no letter, null text, or
   n-grams far from every profile).
2. exact_dedup: of texts equal up to white space the smallest doc id stays.
3. jaccard_join: of documents connected by links (five-word shingles, similarity
   0.8 or more) the smallest doc id stays.
4. secret_scan: found secrets are replaced by a mark; every document stays.
5. packing: the texts' tokens in windows of at most 1024.

Defined cases: a null or empty text, which has no letter, goes in stage 1; in a
later stage null counts as empty.  Very long texts are read whole everywhere.
Ties go to the smallest doc id; of equal rows without doc id one stays in stage 2,
and stage 3, whose links rest on doc ids, keeps them.  Rows repeated with their
doc id are exact copies: stage 2 keeps one.  Further columns are carried along
whatever their names, also where they differ from others only in case; a table
without ``n_chars`` stays without.  An empty table gives empty results.

Tables that a stage stages are deleted when the next stage begins, by when its
result is written; results of other queries are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revscope.llm import exact_dedup, jaccard, language, packing, secret_scan
from revscope.llm._common import Staging, delete, new_folder, numbered, staging

SHINGLE_WORDS, SIMILARITY = 5, (80, 100)

#: Staging of the stage that ran last.
_LAST: list[Staging] = []


def _staged_apart(stage: Callable) -> Callable:
    """``stage`` with a staging of its own, which lives until the next stage begins."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _end()
        own = staging(spark)
        _LAST.append(own)
        own.__enter__()
        try:
            return stage(spark, docs, sf_dir)
        finally:
            own.leave()

    return run


def _end() -> None:
    while _LAST:
        _LAST.pop().close()


@_staged_apart
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.in_learned_language(docs, learn=F.lit(True))


@_staged_apart
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


@_staged_apart
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, SHINGLE_WORDS, *SIMILARITY)


@_staged_apart
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.without_secrets(docs)
    if "n_chars" not in clean.columns:
        return clean
    flat, names = numbered(clean)
    count, text = (names[clean.columns.index(c)] for c in ("n_chars", "text"))
    length = F.length(text).cast(flat.schema[count].dataType)
    return flat.withColumn(count, F.coalesce(length, count)).toDF(*clean.columns)


@_staged_apart
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: Profiles, the links' components and the tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the shared folder and read again.

    A stage's folder goes when the next stage's is written; the last one's is the result."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = new_folder(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            delete(spark, before)
        before = path
    _end()
    return docs
