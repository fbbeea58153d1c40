"""Operator 11, ranked lexical search by accumulator-limited term-at-a-time.

Every item (query) is ranked against every document.  A term is a maximal run
of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
The weight of a term is ``floor(1000 ln((2N+2)/(2df+1)))``, a document's score
the sum over the item's terms of ``w * ((10^9 tf) div (1000 tf + 20 m))`` with
``m = 50 + (50 n N) div L``.

Method.
1. One pass over the texts writes, for each slice of texts, an inverted index
   of the items' terms: term, documents, frequencies; and adds up what N, L and
   df need.  Nothing is shuffled but these sums.
2. A task goes through its slices.  For an item it takes the terms one at a
   time, the rarest (by df over all documents) first, and adds each posting's
   part to its document's accumulator.  Before each term it compares the sum of
   the bounds of the terms left (the largest part that a posting of the slice
   can add) with the kth partial score, of this slice or of the slices before:
   once the sum is smaller, a document without an accumulator cannot reach the
   first k, so none is created any more, and the terms left only update those
   there are, exactly.
3. The first k of each task are merged, k rows an item and task.

Memory is bounded by a slice, its index and k rows an item.  Items come in
blocks of at most ``BLOCK_TERMS`` (item, term) pairs, which bounds what is
broadcast; every block is run against all documents.

Defined cases: null or empty text has no term, counts neither for N nor L and
is never found; an item without terms, or none of whose terms any document
holds, has no rows; a document with score 0 is not returned; rows that repeat a
document id are documents of their own; items that repeat an item id are one
item with the terms of all; equal scores go by ascending doc id, rows without
doc id last; very long texts are counted whole; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.llm._common import pick, ship, staged

#: Rows an item keeps, and the (item, term) pairs of a block.
K, BLOCK_TERMS = 50, 1_000_000
SLICE_BYTES = 16 << 20
#: One term, as a pattern that Spark and DuckDB both take.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of terms, A-Z in lower case; all others as a space.
_TERM_BYTE = np.full(256, 32, np.uint8)
_TERM_BYTE[48:58] = np.arange(48, 58)
_TERM_BYTE[65:91] = np.arange(97, 123)
_TERM_BYTE[97:123] = np.arange(97, 123)
_TERM_BYTE[128:] = np.arange(128, 256)

INDEX = "docs array<long>, lengths array<long>, terms array<int>, counts array<int>, at array<int>, tf array<long>, n_docs long, n_terms long"
FOUND = "item_id long, doc_id long, score long"


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(index into the list of distinct terms for each term, offsets by text, distinct terms)."""
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds - bounds[0]), pa.py_buffer(_TERM_BYTE[data]))
    parts = pc.split_pattern(plain, " ")
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    coded = parts.flatten().dictionary_encode()
    names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    if "" in names:
        real = index != names.index("")
        ends = np.concatenate([[0], np.cumsum(real)])
        index, offsets = index[real], ends[offsets]
    return index.astype(np.int64), offsets, names


def _indexed(words):
    """The inverted index of a slice over the terms in the broadcast dictionary ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import slices

        known = words.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                index, offsets, names = _terms(part.column("text"))
                length = np.diff(offsets)
                asked = np.fromiter((known.get(x, -1) for x in names), np.int64, len(names))
                term, doc = asked[index], np.repeat(np.arange(len(length)), length)
                keep = term >= 0
                key, tf = np.unique(term[keep] * len(length) + doc[keep], return_counts=True)
                term, doc = key // len(length), key % len(length)
                distinct, counts = np.unique(term, return_counts=True)
                held, at = np.unique(doc, return_inverse=True)
                lists = (
                    part.column("doc_id").take(pa.array(held)),
                    pa.array(length[held], pa.int64()),
                    pa.array(distinct, pa.int32()),
                    pa.array(counts, pa.int32()),
                    pa.array(at, pa.int32()),
                    pa.array(tf, pa.int64()),
                )
                columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
                columns += [pa.array([int((length > 0).sum())], pa.int64()), pa.array([int(length.sum())], pa.int64())]
                yield pa.record_batch(columns, [x.split()[0] for x in INDEX.split(", ")])

    return run


class Slice:
    """Postings of a slice: for each term its documents' places and the parts they add, without the weight."""

    def __init__(self, row, n_docs: int, n_terms: int):
        ids = row("docs")
        self.missing = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(0), np.int64)
        m = 50 + (50 * np.asarray(row("lengths"), np.int64) * n_docs) // max(n_terms, 1)
        self.at, tf = np.asarray(row("at"), np.int64), np.asarray(row("tf"), np.int64)
        self.gain = (1_000_000_000 * tf) // (1000 * tf + 20 * m[self.at])
        ends = np.concatenate([[0], np.cumsum(np.asarray(row("counts"), np.int64))])
        self.place = {t: (a, b) for t, a, b in zip(np.asarray(row("terms")).tolist(), ends[:-1].tolist(), ends[1:].tolist())}
        most = np.maximum.reduceat(self.gain, ends[:-1]) if len(self.gain) else np.zeros(0, np.int64)
        self.most = dict(zip(self.place, most.tolist()))


def accumulate(part: Slice, terms: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(places, scores, accumulators made) of the documents of ``part`` that may be among the first ``k``.

    ``terms``: (term, weight), the rarest first; ``floor``: a score that k documents elsewhere have.
    """
    here = [(part.place[t], w, w * part.most[t]) for t, w in terms if t in part.place and w > 0]
    left = sum(bound for _, _, bound in here)
    score, live = np.zeros(len(part.ids), np.int64), np.zeros(len(part.ids), bool)
    made, creating = 0, True
    for (a, b), w, bound in here:
        if creating and left < max(floor, int(score.max(initial=0))):
            least = floor
            if made >= k:
                least = max(least, int(np.partition(score[live], made - k)[made - k]))
            creating = left >= least
        at, add = part.at[a:b], w * part.gain[a:b]
        if creating:
            score[at] += add
            live[at] = True
            made = int(live.sum())
        else:
            known = live[at]
            score[at[known]] += add[known]
        left -= bound
    found = np.flatnonzero(live & (score > 0) & (score >= floor))
    return found, score[found], made


def _first(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, missing, -scores))[:k]


def _ranked(items, k: int, n_docs: int, n_terms: int):
    """The first ``k`` documents of a task for each (item id, terms) in the broadcast list ``items``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = items.value
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        best = [none] * len(asked)
        for batch in batches:
            for i in range(batch.num_rows):
                part = Slice(lambda name: batch.column(name)[i].values, n_docs, n_terms)  # noqa: B023
                for q, (_, terms) in enumerate(asked):
                    scores, ids, missing = best[q]
                    floor = int(scores[-1]) if len(scores) == k else 0
                    found, score, _ = accumulate(part, terms, k, floor)
                    if len(found):
                        scores, ids, missing = np.append(scores, score), np.append(ids, part.ids[found]), np.append(missing, part.missing[found])
                        order = _first(scores, ids, missing, k)
                        best[q] = scores[order], ids[order], missing[order]
        counts = [len(x[0]) for x in best]
        if sum(counts):
            scores, ids, missing = (np.concatenate(x) for x in zip(*best))
            item = pa.array([x[0] for x in asked], pa.int64()).take(pa.array(np.repeat(np.arange(len(asked)), counts)))
            yield pa.record_batch({"item_id": item, "doc_id": pa.array(ids, mask=missing), "score": pa.array(scores, pa.int64())})

    return run


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms): the distinct terms of each item."""
    lower = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    rows = pick(items, item_id=id_col, text=text_col).select(F.col("item_id").cast("long"), F.regexp_extract_all(lower, F.lit(f"({TERM})")).alias("t"))
    return rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("t")))).alias("terms")).filter(F.size("terms") > 0)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Each item's ``k`` highest-scoring documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    ship(spark)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    asked = staged(item_terms(items, item_col, query_col), "items")
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, math.ceil(pairs / block_terms))
    found = spark.createDataFrame([], FOUND)
    for block in range(blocks if pairs else 0):
        own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # at most a block's terms
        names = sorted({t for r in own for t in r.terms})
        place = {t: i for i, t in enumerate(names)}
        words = spark.sparkContext.broadcast(place)
        index = staged(narrow.mapInArrow(_indexed(words), INDEX), "postings")
        n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        cells = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("c"))
        df = {r.term: r.df for r in cells.groupBy(F.col("c.terms").alias("term")).agg(F.sum("c.counts").alias("df")).collect()}  # a block's terms
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        queries = [(r.item_id, [(t, weight[t]) for t in sorted((place[x] for x in r.terms if place[x] in df), key=lambda t: (df[t], t))]) for r in own]
        lists = spark.sparkContext.broadcast(queries)
        found = found.unionByName(index.mapInArrow(_ranked(lists, k, n_docs or 0, n_terms or 0), FOUND))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


ORACLE = f"""
WITH
words AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, n_docs),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * n_docs) // n_terms)))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN lengths USING (doc_id) JOIN weights USING (term), totals GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}
"""
