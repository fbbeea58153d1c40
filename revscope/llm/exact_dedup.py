"""Operator 2, exact de-duplication by recipes of content-defined chunks (DataFrame functions only).

Method: a normalised text is cut where its own content says so (two characters
of a fixed class in a row, at least ``MIN_CHUNK`` after the last cut; a run of
``MAX_CHUNK`` without one is cut there).  A chunk's identifier is its SHA-256.
Identifiers are verified: each distinct chunk moves once, and an identifier
that stands for two different chunks is found by comparing them.  A document is
then the ordered list of its identifiers, its recipe; equal texts are equal
recipes (were an identifier ambiguous, chunks would be compared with recipes).
Only recipes, 32 bytes a chunk, are shuffled to group documents; copies
collapse in the map-side aggregation, and the join back reads the written
groups, so a hot group's rows can be split over tasks.

Defined cases: null text equals empty text; of equal texts the smallest doc id
stays, null ids coming last, and of rows that repeat an id and a text one
stays; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import measured, numbered, pick, staged

#: Runs of ``[\\x20\\x09-\\x0D]`` other than a single space, which needs no change.
SPACES = r"(?:[\x09-\x0D]|\x20(?=[\x20\x09-\x0D]))[\x20\x09-\x0D]*"
MIN_CHUNK, MAX_CHUNK = 256, 4096
#: Code points of the class whose doubled occurrence ends a chunk.
CUT_CLASS = "".join(f"\\x{{{c:x}}}" for c in range(0x20, 0x250) if c * 2654435761 % 2**32 < 0.12 * 2**32)
CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK - 2}}}?[{CUT_CLASS}]{{2}}|.{{1,{MAX_CHUNK}}}"


def normalised(text: Column | str) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), SPACES, " ")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, chunks, recipe (the chunks' identifiers), text_sha256, row (a number of its own)."""
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), normalised("text").alias("text"))
    chunks = narrow.select("doc_id", F.regexp_extract_all("text", F.lit(CHUNK), 0).alias("chunks"), F.sha2("text", 256).alias("text_sha256"))
    recipe = F.transform("chunks", lambda c: F.unhex(F.sha2(c, 256)))
    return chunks.select("doc_id", "chunks", recipe.alias("recipe"), "text_sha256", F.monotonically_increasing_id().alias("row"))


def ambiguous(rows: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk (none, unless SHA-256 collides)."""
    pairs = rows.select(F.explode(F.arrays_zip("recipe", "chunks")).alias("c")).select("c.recipe", "c.chunks").distinct()
    return pairs.groupBy("recipe").agg(F.count("*").alias("n")).filter("n > 1").select("recipe")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(recipes(docs, id_col, text_col), "recipes")
    # identifiers verified by comparing the chunks; were one ambiguous, the chunks themselves would be compared
    trusted = ambiguous(rows).limit(1).count() == 0
    key = ["recipe"] if trusted else ["recipe", "chunks"]
    rows = rows.select("doc_id", "row", "text_sha256", *key)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "row")).alias("first")
    groups = rows.groupBy(*key).agg(first, F.count("*").alias("group_size")).filter("group_size > 1")
    groups = staged(groups.select(*key, F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"), "groups")
    joined = rows.join(groups, key, "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns.

    Rows are told by id and digest; whole rows are shuffled only against a long
    list of those that go, and where rows repeat an id and a text.
    """
    rows = staged(exact_dedup(docs, id_col, text_col), "dedup")
    told = rows.groupBy("doc_id", "text_sha256").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("n"))
    told = staged(told.filter("not kept or n > 1").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), "kept"), "told")
    gone, repeated = told.filter("not kept"), told.filter("kept")
    flat, names = numbered(docs)
    doc, text = (F.col(names[docs.columns.index(c)]) for c in (id_col, text_col))
    own = flat.select("*", doc.cast("long").alias("__doc"), F.sha2(normalised(text), 256).alias("__text"))

    def joined(left: DataFrame, marks: DataFrame, how: str) -> DataFrame:
        return left.join(measured(marks), left["__doc"].eqNullSafe(marks["__id"]) & (left["__text"] == marks["__sha"]), how)

    left = joined(own, gone, "left_anti")
    if repeated.limit(1).count():
        once = joined(left, repeated, "left_semi").dropDuplicates(["__doc", "__text"])
        left = joined(left, repeated, "left_anti").unionByName(once)
    return left.select(*names).toDF(*docs.columns)


ORACLE = """
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
"""
