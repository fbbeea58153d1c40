"""Operator 1, packing: documents' tokens in windows of nearly equal fill.

Method: a document is cut into full windows and a remainder of small pieces.
The pieces of a block are packed by Karmarkar-Karp multiway differencing: they
are dealt, by descending size, into partial partitions of one piece a window,
and the two partial partitions of the largest imbalance are merged again and
again, the fullest window of one with the emptiest of the other.  If a window
then exceeds the capacity, the block gets one more window and starts over.

Blocks are made inside each input partition, so no token and no piece is
shuffled, memory holds one slice of texts and one block of pieces, and a task
that runs again after a lost executor yields the same windows.

Defined cases: null text counts as empty (its only id is the end id); null,
repeated or unordered doc ids are carried along as they are; further columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import pick, ship

CAPACITY = 1024
PIECE = 128
BLOCK = 4096
SLICE_BYTES = 6 << 20
END_ID = 0

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece, by multiway differencing into ``windows`` windows."""
    order = np.argsort(-sizes, kind="stable")
    n = -(-max(len(sizes), 1) // windows) * windows
    padded = np.full(n, -1, np.int64)
    padded[: len(order)] = order
    heap: list = []
    for t, members in enumerate(padded.reshape(-1, windows)):
        sums = np.where(members >= 0, sizes[members], 0)
        heap.append((int(sums.min() - sums.max()), t, sums, [members]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, t, a, held = heapq.heappop(heap)
        _, _, b, more = heapq.heappop(heap)
        up, down = np.argsort(a, kind="stable"), np.argsort(-b, kind="stable")
        sums = a[up] + b[down]
        held = [m[up] for m in held] + [m[down] for m in more]
        heapq.heappush(heap, (int(sums.min() - sums.max()), t, sums, held))
    out = np.zeros(len(sizes), np.int64)
    for members in heap[0][3]:
        there = members >= 0
        out[members[there]] = np.flatnonzero(there)
    return out


def windows_of(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The window of each piece, no window holding over ``capacity``."""
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at = differencing(sizes, count)
        if np.bincount(at, weights=sizes, minlength=count).max() <= capacity:
            return at
        count += 1


class Cut(NamedTuple):
    """Pieces of a slice of documents; ``row`` and ``at`` tell where their ids lie."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray


def cut_documents(counts: np.ndarray, capacity: int, piece: int) -> Cut:
    """Full windows, and the remainder in equal pieces of at most ``piece`` ids."""
    full, rest = counts // capacity, counts % capacity
    parts = -(-rest // piece)
    row = np.repeat(np.arange(len(counts)), full + parts)
    ends = np.cumsum(full + parts)
    k = np.arange(len(row)) - np.repeat(ends - (full + parts), full + parts)
    j = k - full[row]
    share = rest[row] // np.maximum(parts[row], 1)
    over = rest[row] - share * np.maximum(parts[row], 1)
    length = np.where(j < 0, capacity, share + (j < over))
    start = np.where(j < 0, k * capacity, full[row] * capacity + j * share + np.minimum(np.maximum(j, 0), over))
    return Cut(row, start, length)


def _packer(path: str, capacity: int, piece: int, block: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import lean, slices, token_ids, trim
        from revscope.llm._tokenizer import vocabulary

        lean()
        vocab = vocabulary(path)
        sequence = TaskContext.get().partitionId() << 36
        waiting: list[pa.Table] = []

        def packed(rows: pa.Table) -> pa.Table:
            """Sequence and offset of a block's pieces, or of whole windows."""
            nonlocal sequence
            sizes = rows.column("length").to_numpy()
            at = windows_of(sizes, capacity) if sizes.max() < capacity else np.arange(len(sizes))
            order = np.argsort(at, kind="stable")
            ends = np.cumsum(sizes[order])
            first = np.searchsorted(at[order], at[order])
            offset = np.empty(len(sizes), np.int64)
            offset[order] = ends - sizes[order] - (ends - sizes[order])[first]
            used = np.unique(at, return_inverse=True)[1]
            rows = rows.append_column("sequence_id", pa.array(sequence + used)).append_column("offset", pa.array(offset))
            sequence += int(used.max()) + 1
            return rows

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, counts = token_ids(part.column("text"), vocab)
                totals = counts + 1
                at = np.cumsum(totals)
                tokens = np.full(int(at[-1]) if len(at) else 0, END_ID, np.uint32)
                keep = np.ones(len(tokens), bool)
                keep[at - 1] = False
                tokens[keep] = ids
                cut = cut_documents(totals, capacity, piece)
                begin = (at - totals)[cut.row] + cut.start
                view = memoryview(tokens).cast("B")
                spans = [view[4 * b : 4 * e] for b, e in zip(begin.tolist(), (begin + cut.length).tolist())]
                columns = {
                    "doc_id": part.column("doc_id").take(pa.array(cut.row)),
                    "start": pa.array(cut.start),
                    "length": pa.array(cut.length),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in spans], pa.int64()),
                    "doc_tokens": pa.array(totals[cut.row]),
                }
                if with_ids:
                    columns["ids"] = pa.array([x.tobytes() for x in spans], pa.binary())
                rows = pa.table(columns)
                whole = pa.array(cut.length == capacity)
                if cut.length.max(initial=0) == capacity:
                    yield from packed(rows.filter(whole)).to_batches()
                waiting.append(rows.filter(pa.array(cut.length < capacity)))
                if sum(x.num_rows for x in waiting) >= block:
                    rows = pa.concat_tables(waiting)
                    full = rows.num_rows // block * block
                    for k in range(0, full, block):
                        yield from packed(rows.slice(k, block).combine_chunks()).to_batches()
                    waiting = [rows.slice(full)]
        if sum(x.num_rows for x in waiting):
            yield from packed(pa.concat_tables(waiting).combine_chunks()).to_batches()
        waiting.clear()
        trim()

    return run


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    piece: int = PIECE,
    block: int = BLOCK,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    ``path`` is a ``tokenizers`` vocabulary file; each document's ids end with
    id 0.  ``with_ids`` adds the piece's ids (little-endian unsigned 32-bit).
    """
    ship(docs.sparkSession)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = PIECES.replace("doc_tokens long,", "doc_tokens long, ids binary,") if with_ids else PIECES
    return narrow.mapInArrow(_packer(path, capacity, piece, block, with_ids), schema)


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = END_ID) -> DataFrame:
    """The packed sequences of ``pack(..., with_ids=True)``: ids, padded to ``capacity``
    except where a sequence's length is a power of two, and each piece's place."""
    ids = F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"])))
    length = F.aggregate("p", F.lit(0).cast("long"), lambda s, x: s + x["length"])
    # four bytes an id are eight hex digits
    padded = F.when(F.log2("n") == F.floor(F.log2("n")), F.col("h")).otherwise(
        F.concat(F.col("h"), F.repeat(F.lit(pad_id.to_bytes(4, "little").hex().upper()), (F.lit(capacity) - F.col("n")).cast("int")))
    )
    return (
        pieces.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"))
        .select("sequence_id", ids.alias("h"), length.alias("n"),
                F.transform("p", lambda x: F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["length"].alias("length"), x["offset"].alias("offset"))).alias("pieces"))
        .select("sequence_id", F.unhex(padded).alias("ids"), F.col("n").alias("tokens"), "pieces")
    )
