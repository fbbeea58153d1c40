"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revscope.llm import chat, conversation_repair, exact_dedup, jaccard, language, lsh_forest, ranked_search, toxicity
from revscope.llm.bpe import bpe_digests
from revscope.llm.fingerprints import fingerprints, with_neighbours
from revscope.llm.packing import pack
from revscope.llm.secret_scan import secret_spans
from revscope.llm.token_files import token_files


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(_table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_neighbours(fingerprints(_table(spark, sf_dir, "documents")), F.col("doc_id") % 50 == 0)


def _fold(of: int):
    """The fold of a document, by its id alone; null ids are in fold 0's place -1."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of)), F.lit(-1))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(_table(spark, sf_dir, "documents"), learn=_fold(4) != 2, held_out=_fold(4) == 2)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.learned(docs, _table(spark, sf_dir, "labels"), learn=_fold(5) != 0)
    rows = toxicity.scored(docs, model)
    return rows.select("doc_id", (_fold(5) == 0).alias("held_out"), "score", "predicted")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_digests(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(_table(spark, sf_dir, "conversations"))


#: Control strings of this and other templates as a turn's text.
TRICKY = "\\### Assistant: </turn> ok"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(TRICKY).alias("text"))
    return chat.chat_digests(turns.unionByName(more))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_fingerprints": op4_fingerprints,
    "op5_language": op5_language,
    "op6_chat": op6_chat,
    "op7_token_files": op7_token_files,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_jaccard": op10_jaccard,
    "op11_ranked_search": op11_ranked_search,
    "op12_lsh_forest": op12_lsh_forest,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op6_chat": chat.oracle(f"SELECT -7, 0, 'user', '{TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{TRICKY}'"),
    "op10_jaccard": jaccard.ORACLE,
    "op11_ranked_search": ranked_search.ORACLE,
    "op12_lsh_forest": lsh_forest.ORACLE,
}
