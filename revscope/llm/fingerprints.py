"""Operator 4, document fingerprints by SimHash.

Method: a text's terms are its runs of three words (fewer words: all of them as
one), weighted by how often they occur.  Each term's 128-bit hash votes, with
its weight, on every bit; a fingerprint has the bits with more votes for than
against.  Fingerprints within a Hamming radius are found with permuted block
tables: the bits are cut into ``radius + spare`` blocks, and two fingerprints
within the radius agree on at least ``spare`` of them; each choice of so many
blocks is a table whose key they share.

The likeness of two fingerprints is the cosine their Hamming distance stands
for, cos(pi * distance / bits), and 0 where that is negative.

Whole texts move once, into descending order of doc id, to meet the next one;
each range keeps only the text before in memory.  What crosses the ranges'
edges is one first and one last document a range.

Very long texts are read whole; a slice of texts in memory holds one of them
beyond its usual size, and a term's votes are summed in runs of bounded length.

Defined cases: null text counts as empty; a text without words has the zero
fingerprint; null doc ids come last, repeated ids are ordered by text; a single
document is its own next one; a null doc id is never a query of the block tables
by its number; further columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revscope.llm._common import measured, pick, ship, staged
from revscope.llm._words import mix, shingle_hashes, word_hashes

BITS, TERM_WORDS = 128, 3
#: Bits by which two fingerprints may differ to count as neighbours.
RADIUS = 3
SLICE_BYTES = 4 << 20
#: Rows whose votes fit a byte; sums of more are taken from sums of such.
_RUN = 255


def simhash(texts: pa.Array, words: int = TERM_WORDS) -> np.ndarray:
    """Fingerprints, a row of 16 bytes for each text."""
    terms, ends = shingle_hashes(*word_hashes(texts), words)
    n = len(ends) - 1
    out = np.zeros((n, BITS // 8), np.uint8)
    counts = np.diff(ends)
    filled = np.flatnonzero(counts)
    for low, high in _runs(ends, 1 << 18):
        rows = filled[(filled >= low) & (filled < high)]
        if not len(rows):
            continue
        part = terms[ends[low] : ends[high]]
        votes = np.unpackbits(np.stack([mix(part, 11), mix(part, 12)], axis=1).view(np.uint8), axis=1).view(np.uint64)
        start = ends[rows] - ends[low]
        runs = -(-counts[rows] // _RUN)
        first = np.cumsum(runs) - runs
        inner = np.arange(int(runs.sum())) - np.repeat(first, runs)
        cuts = np.repeat(start, runs) + inner * _RUN
        sums = np.add.reduceat(votes, cuts, axis=0).view(np.uint8).astype(np.int64)
        sums = np.add.reduceat(sums, first, axis=0)
        out[rows] = np.packbits(2 * sums > counts[rows][:, None], axis=1)
    return out


def _runs(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``most`` terms."""
    at, n = 0, len(ends) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield at, to
        at = to


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    distance = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    return np.where(distance == 0, 1.0, np.maximum(0.0, np.cos(np.pi * distance / BITS)))


def _edited(text: str, following: str) -> str:
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(docs: list, texts: list[str], after: list[str]) -> dict:
    """The result columns of texts, each followed by the one in ``after``."""
    edited = [_edited(t, x) for t, x in zip(texts, after)]
    own, changed, following = np.split(simhash(pa.array([*texts, *edited, after[-1]], pa.large_string())), [len(texts), 2 * len(texts)])
    # all but the last of ``after`` are the texts themselves, one later
    following = np.concatenate([own[1:], following]) if len(texts) > 1 else following
    return {
        "doc_id": pa.array(docs, pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
        "fingerprint": pa.array([x.tobytes().hex() for x in own]),
        "edited_fingerprint": pa.array([x.tobytes().hex() for x in changed]),
        "near_edited": pa.array(likeness(own, changed)),
        "near_next": pa.array(likeness(own, following)),
    }


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows but a range's last, whose next text another range has; that and the first go out as edges."""
    from revscope.llm._segments import slices

    place = TaskContext.get().partitionId()
    held: tuple[list, list[str]] = ([], [])

    def out(columns: dict, edge: int, texts: list) -> pa.RecordBatch:
        n = len(columns["doc_id"])
        columns = columns | {"edge": pa.array([edge] * n, pa.int32()), "place": pa.array([place] * n, pa.int64()), "text": pa.array(texts, pa.string())}
        return pa.record_batch(columns)

    def edge(kind: int, doc, text: str) -> pa.RecordBatch:
        types = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
        columns = {"doc_id": pa.array([doc], pa.int64())} | {c: pa.nulls(1, types.get(c, pa.string())) for c in ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
        return out(columns, kind, [text])

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            docs, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
            if not held[0]:
                yield edge(1, docs[0], texts[0])
            docs, texts = held[0] + docs, held[1] + texts
            if len(docs) > 1:
                yield out(_compared(docs[:-1], texts[:-1], texts[1:]), 0, [None] * (len(docs) - 1))
            held = docs[-1:], texts[-1:]
    if held[0]:
        yield edge(2, held[0][0], held[1][0])


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, text, after in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "after"))):
            yield pa.record_batch(_compared([doc], [text], [after]))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness."""
    ship(docs.sparkSession)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    order = F.col("doc_id").desc_nulls_last(), F.col("text").asc()
    ordered = narrow.repartitionByRange(F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)
    rows = staged(ordered.mapInArrow(_in_order, f"{COLUMNS}, edge int, place long, text string"), "fingerprints")
    first = rows.filter("edge = 1").select("place", F.col("text").alias("after"))
    last = rows.filter("edge = 2").select("place", "doc_id", "text")
    # one row a range; the last range is followed by the first
    by_place = Window.orderBy("place")
    following = first.select("place", F.coalesce(F.lead("place").over(by_place), F.first("place").over(by_place)).alias("next"))
    met = last.join(following, "place").join(first.withColumnRenamed("place", "next"), "next").select("doc_id", "text", "after")
    over = staged(met.mapInArrow(_over_edges, COLUMNS), "edges")
    return rows.filter("edge = 0").drop("edge", "place", "text").unionByName(over)


def _halves(bits: int) -> list:
    """A hex fingerprint as numbers of 64 bits."""
    return [F.conv(F.substring("fingerprint", 1 + 16 * i, 16), 16, -10).cast("long").alias(f"part{i}") for i in range(bits // 64)]


def _tables(radius: int, spare: int, bits: int) -> list[list[int]]:
    """The masks of each table: the bits of one choice of ``spare`` blocks, as signed numbers of 64 bits."""
    blocks = radius + spare
    masks = []
    for choice in combinations(range(blocks), spare):
        whole = sum(1 << (bits - 1 - b) for i in choice for b in range(bits * i // blocks, bits * (i + 1) // blocks))
        parts = [(whole >> (bits - 64 * (i + 1))) & (2**64 - 1) for i in range(bits // 64)]
        masks.append([x - 2**64 if x >> 63 else x for x in parts])
    return masks


def radius_pairs(prints: DataFrame, queries: DataFrame, radius: int, spare: int = 2, bits: int = BITS) -> DataFrame:
    """(fingerprint, found, n, distance): each distinct fingerprint of ``queries``, those of ``prints``
    within ``radius`` of it, each pair once, and how many documents have the one found.

    A table's key is a hash of the bits it keeps, so what crosses a shuffle is a few numbers a
    fingerprint and table.  A pair that several tables bring together counts in the first of them only,
    inside the join.  The queries' keys are broadcast while they are counted at no more than
    ``BROADCAST_ROWS``; beyond that both sides are shuffled by key.
    """
    parts = [f"part{i}" for i in range(bits // 64)]
    masks = _tables(radius, spare, bits)
    key = lambda t: F.xxhash64(F.lit(t), *[F.col(c).bitwiseAND(F.lit(m)) for c, m in zip(parts, masks[t])])
    keys = F.explode(F.array(*[F.struct(F.lit(t).alias("table"), key(t).alias("key")) for t in range(len(masks))])).alias("k")
    found = [f"found_{c}" for c in parts]
    held = prints.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).select(*_halves(bits), "n")
    table = held.select(*parts, "n", keys).select(*[F.col(c).alias(f) for c, f in zip(parts, found)], "n", "k.table", "k.key")
    asked = queries.select("fingerprint").distinct().select(*_halves(bits)).select(*parts, keys).select(*parts, "k.table", "k.key")
    differ = [F.col(c).bitwiseXOR(F.col(f)) for c, f in zip(parts, found)]
    agree = F.array(*[reduce(and_, [d.bitwiseAND(F.lit(m)) == 0 for d, m in zip(differ, mask)]) for mask in masks])
    distance = reduce(add, [F.bit_count(d) for d in differ])
    side = measured(staged(asked, "asked").select(*parts, F.col("table").alias("of"), F.col("key").alias("sought")))
    same = (F.col("table") == F.col("of")) & (F.col("key") == F.col("sought"))
    first = F.array_position(agree, True) == F.col("table") + 1
    pairs = table.join(side, same & (distance <= radius) & first)
    text = lambda columns: F.lower(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in columns]))
    return pairs.select(text(parts).alias("fingerprint"), text(found).alias("found"), "n", distance.alias("distance"))


def within_radius(prints: DataFrame, queries: DataFrame, radius: int, spare: int = 2, bits: int = BITS) -> DataFrame:
    """(query, doc_id, distance): all fingerprints of ``prints`` within ``radius`` of each query's.

    Both have doc_id and fingerprint (hex).  Equal fingerprints are looked up
    as one; a query's answers name every document.
    """
    pairs = radius_pairs(prints, queries, radius, spare, bits).drop("n")
    named = queries.select(F.col("doc_id").alias("query"), "fingerprint").join(pairs, "fingerprint")
    return named.join(prints.select("doc_id", F.col("fingerprint").alias("found")), "found").select("query", "doc_id", "distance")


def with_neighbours(prints: DataFrame, asked: Column, radius: int = RADIUS, spare: int = 2) -> DataFrame:
    """``prints`` and ``n_within_radius``: how many of all its documents, itself included, have a fingerprint
    within ``radius`` of the document's own; null where ``asked`` does not hold.

    Answers are found and counted by distinct fingerprint, so copies are not expanded into pairs."""
    asked = F.coalesce(asked, F.lit(False))
    queries = prints.filter(asked)
    pairs = radius_pairs(prints, queries, radius, spare)
    counts = staged(pairs.groupBy("fingerprint").agg(F.sum("n").alias("n_within_radius")), "neighbours")
    rest = prints.filter(~asked).withColumn("n_within_radius", F.lit(None).cast("long"))
    return queries.join(measured(counts), "fingerprint").select(*rest.columns).unionByName(rest)
