"""Operator 10, n-gram Jaccard join by a token-group matrix.

Two documents link when their sets of word shingles have a Jaccard similarity
of 0.9 or more (a ratio of integers, compared exactly).

Method.
1. One pass over the texts makes each set's size, a 128-bit digest (equal sets
   are one class from here on) and its tokens, the shingles' hashes.  The tokens
   are exchanged to find which of them other sets hold too (``_shared``); of a
   set only those can be in an intersection, so a set that has fewer of them
   than the similarity needs links with nothing.  This is exact at any
   similarity, and what most documents share with others does not reach it.
2. The sets left, reduced to these tokens, are partitioned into groups of
   similar sets, of bounded size.  Inside a group, a matrix of members by tokens
   gives all overlaps at once (``_matrix``).
3. Groups are compared with each other through their token unions: tokens that
   one component alone holds are dropped first, with the sets that have too few
   others.  A set meets the groups that hold one of its rarest tokens among their
   members' rarest; its overlap with a group's union bounds that with each
   member, and only groups where it is enough for a link are opened, in blocks.
Links leave a task as a spanning forest, never as all pairs; a set that lies in
one component with a group's members is not compared with them again.

Tokens are 64-bit hashes, of which at least 49 bits are exchanged.  The table
must give its rows in the same order when read again, as files do.

Defined cases: null text counts as empty; a document without words has an empty
set and links with nothing; one with fewer than ``size`` words has its whole
sequence as one shingle; very long texts are one set, whole; rows that repeat a
doc id are one node of the links; a text that only rows without doc id have gets
a null component and passes no link on; repeated rows each get a row; further
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm import _shared
from revscope.llm._common import measured, numbered, pick, ship, staged
from revscope.llm._matrix import link_components
from revscope.llm._words import mix, shingle_hashes, word_hashes

SIZE = 3
#: The similarity as a fraction: a link when ``DEN * intersection >= NUM * union``.
NUM, DEN = 90, 100
SLICE_BYTES = 8 << 20


def text_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted shingle hashes of all texts, each once a text, and each text's count."""
    found, ends = shingle_hashes(*word_hashes(texts), size)
    sets = [np.unique(found[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.array([len(s) for s in sets], np.int64)


def digests(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set."""
    ends = np.cumsum(sizes)
    out = []
    for salt in (1, 2):
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens, salt), dtype=np.uint64)])
            out.append((sums[ends] - sums[ends - sizes]).view(np.int64))
    return out[0], out[1]


def firsts(sizes: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """Whether each set is the first of its kind in the slice, and not empty."""
    pairs = np.stack([d1, d2], axis=1)
    first = np.zeros(len(sizes), bool)
    first[np.unique(pairs, axis=0, return_index=True)[1]] = True
    return first & (sizes > 0)


def _dealt(size: int, bits: int):
    """The texts' sets, a slice at a time, their tokens dealt to the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from revscope.llm._segments import lean, slices, trim

        lean()

        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                for low in range(0, part.num_rows, _shared.MOST_SETS):
                    rows = part.slice(low, _shared.MOST_SETS)
                    tokens, sizes = text_sets(rows.column("text"), size)
                    d1, d2 = digests(tokens, sizes)
                    kept = firsts(sizes, d1, d2)
                    at = np.where(kept, np.cumsum(kept) - 1, -1)
                    every = np.repeat(kept, sizes)
                    place = np.repeat(at, sizes)[every].astype(np.uint64)
                    docs = pa.StructArray.from_arrays(
                        [rows.column("doc_id"), pa.array(sizes), pa.array(d1), pa.array(d2), pa.array(at, pa.int32())], ["id", "n", "k1", "k2", "at"]
                    )
                    yield _shared.dealt(number, docs, tokens[every], place, None, bits)
                    number += 1
        trim()

    return run


def node_edges(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(src, dst) for doc ids with several different sets: these are one node."""
    several = rows.filter("n > 0 and id is not null").groupBy("id").agg(F.min("k1").alias("a"), F.max("k1").alias("b")).filter("a <> b")
    own = rows.select("id", "k1", "k2").join(several.select("id"), "id", "left_semi").join(classes, ["k1", "k2"])
    return own.filter("first_id is not null").select(F.col("id").alias("src"), F.col("first_id").alias("dst"))


def jaccard_components(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc id reachable by links)."""
    ship(docs.sparkSession)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    bits = _shared.part_bits(_shared.token_count(narrow))
    cells = narrow.mapInArrow(_dealt(size, bits), _shared.CELLS)
    rows = staged(_shared.shared_tokens(cells, bits, num, den, owners=False), "sets")
    classes = staged(rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("first_id")), "classes")
    left = rows.filter("members is not null").dropDuplicates(["k1", "k2"]).join(classes, ["k1", "k2"]).filter("first_id is not null")
    sets = staged(left.select(F.col("first_id").alias("cid"), "n", F.col("k1").alias("key"), "members"), "members")
    found = link_components(sets, num, den, known=node_edges(rows, classes))
    return components_of(rows, classes, found)


def components_of(rows: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Each document's size and component from its class's."""
    named = classes.join(found, classes["first_id"] == found["node"], "left").select("k1", "k2", F.coalesce("component", "first_id").alias("component_id"))
    result = rows.select("id", "n", "k1", "k2").join(staged(named, "named"), ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_of_each(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of linked documents those of the smallest doc id.

    Rows without doc id and documents without words, which link with nothing, stay.
    """
    found = jaccard_components(docs, size, num, den, id_col, text_col)
    gone = staged(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    flat, names = numbered(docs)
    own = flat[names[docs.columns.index(id_col)]].cast("long")
    return flat.join(measured(gone), own == gone["__gone"], "left_anti").toDF(*docs.columns)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {SIZE} THEN [array_to_string(w[i:i + {SIZE} - 1], ' ') FOR i IN range(1, len(w) - {SIZE} + 2)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE {DEN} * common.n >= {NUM} * (x.n + y.n - common.n)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
SELECT reached.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY reached.doc_id
"""
