"""Which tokens of a set do other sets hold?  Packed exchange for the operators that link sets.

A slice of sets sends each of its distinct tokens once, to the part of the
token space that it falls in; the part answers the slices whose token another
set holds too; the answers of a slice meet again.  What a token costs does not
depend on how many sets hold it: a slice that holds one twice knows the answer
and sends one mark, so a passage of a third of all documents is one entry a
slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm._segments import trimmed

#: Bytes of a token (besides the bits that chose its part), of the place in its slice, of its owner.
TOKEN_BYTES, PLACE_BYTES, OWNER_BYTES = 6, 2, 8
#: Places that say: the slice knows the answer; several sets of one owner wait for it.
KNOWN, SEVERAL = 0xFFFF, 0xFFFE
#: Sets of a slice at most.
MOST_SETS = 60_000

DOCS = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32())]))
CELLS = "slice long, part int, cells binary, docs array<struct<id:long,n:long,k1:long,k2:long,at:int>>, direct binary, waiting binary"
_ANSWERS = "slice long, cells binary, docs array<struct<id:long,n:long,k1:long,k2:long,at:int>>, direct binary, waiting binary"
ROWS = "id long, n long, k1 long, k2 long, members binary"


def packed(numbers: np.ndarray, width: int) -> bytes:
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def cut(tokens: np.ndarray, bits: int) -> np.ndarray:
    """``tokens`` to the bits that are exchanged: those that choose the part and TOKEN_BYTES more."""
    low = max(0, 64 - bits - 8 * TOKEN_BYTES)
    return tokens >> np.uint64(low) << np.uint64(low)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts, and the length."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1], [True]]))


def dealt(slice_id: int, docs: pa.Array, token: np.ndarray, place: np.ndarray, owner: np.ndarray | None, bits: int) -> pa.RecordBatch:
    """The rows (CELLS) of a slice: its sets' tokens (one entry a set and token), dealt to their parts.

    ``owner``: of each entry; tokens that one owner alone holds are not shared.  None: each set for itself.
    """
    token = cut(token, bits)
    order = np.argsort(token, kind="stable")
    token, place = token[order], place[order]
    owner = owner[order] if owner is not None else None
    starts = _runs(token)
    count = np.diff(starts)
    first = starts[:-1]
    if owner is None:
        known, several = count > 1, np.zeros(len(count), bool)
    else:
        least = np.minimum.reduceat(owner, first) if len(first) else owner
        most = np.maximum.reduceat(owner, first) if len(first) else owner
        known = least != most
        several = ~known & (count > 1)
    sent, to = token[first], np.where(known, KNOWN, np.where(several, SEVERAL, place[first] if len(first) else 0)).astype(np.uint64)
    pack = lambda mask: packed(token[mask], 8) + packed(place[mask], PLACE_BYTES)
    direct, waiting = pack(np.repeat(known, count)), pack(np.repeat(several, count))
    own = owner[first] if owner is not None else None
    part = sent >> np.uint64(64 - bits)
    edges = _runs(part)
    filled = list(zip(part[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist())) or [(slice_id % (1 << bits), 0, 0)]
    rest = sent << np.uint64(bits) >> np.uint64(64 - 8 * TOKEN_BYTES)
    cells = [packed(rest[a:b], TOKEN_BYTES) + packed(to[a:b], PLACE_BYTES) + (packed(own[a:b], OWNER_BYTES) if own is not None else b"") for _, a, b in filled]
    carrier = slice_id % len(filled)  # the parts share what goes straight to the slice
    return pa.record_batch(
        {
            "slice": pa.array([slice_id] * len(filled), pa.int64()),
            "part": pa.array([p for p, _, _ in filled], pa.int32()),
            "cells": pa.array(cells, pa.binary()),
            "docs": _one(docs, carrier, len(filled)),
            "direct": pa.array([direct if i == carrier else b"" for i in range(len(filled))], pa.binary()),
            "waiting": pa.array([waiting if i == carrier else b"" for i in range(len(filled))], pa.binary()),
        }
    )


def _one(docs: pa.Array, at: int, n: int) -> pa.ListArray:
    """A list column of ``n`` rows that holds ``docs`` in row ``at`` and nothing else."""
    offsets = np.zeros(n + 1, np.int32)
    offsets[at + 1 :] = len(docs)
    return pa.ListArray.from_arrays(pa.array(offsets), docs)


def _answered(bits: int, owners: bool):
    """The entries of a part whose token another set (another owner) holds too, by slice."""
    width = TOKEN_BYTES + PLACE_BYTES + (OWNER_BYTES if owners else 0)

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        cells = table.column("cells").to_pylist()
        n = np.array([len(x) // width for x in cells], np.int64)
        field = lambda a, b, w: unpacked(b"".join(x[a * k : b * k] for x, k in zip(cells, n.tolist())), w)
        rest = field(0, TOKEN_BYTES, TOKEN_BYTES)
        place = field(TOKEN_BYTES, TOKEN_BYTES + PLACE_BYTES, PLACE_BYTES)
        order = np.argsort(rest, kind="stable")
        starts = _runs(rest[order])
        first, count = starts[:-1], np.diff(starts)
        shared = np.zeros(len(first), bool)
        if len(first):
            known = np.maximum.reduceat((place == KNOWN)[order], first)
            if owners:
                owner = field(TOKEN_BYTES + PLACE_BYTES, width, OWNER_BYTES)[order]
                shared = known | (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first))
            else:
                shared = known | (count > 1)
        hit = np.zeros(len(rest), bool)
        hit[order] = np.repeat(shared, count)
        hit &= place != KNOWN
        token = (np.uint64(part) << np.uint64(64 - bits)) | (rest << np.uint64(64 - 8 * TOKEN_BYTES) >> np.uint64(bits))
        ends = np.concatenate([[0], np.cumsum(n)]).tolist()
        answers = []
        for a, b in zip(ends, ends[1:]):
            at = np.flatnonzero(hit[a:b]) + a
            answers.append(packed(token[at], 8) + packed(place[at], PLACE_BYTES))
        out = pa.table({"slice": table.column("slice"), "cells": pa.array(answers, pa.binary()), **{c: table.column(c) for c in ("docs", "direct", "waiting")}})
        return out.filter(pc.or_(pa.chunked_array([pa.array([bool(x) for x in answers])]), pc.fill_null(pc.greater(pc.list_value_length(table.column("docs")), 0), False)))

    return run


def _met(num: int, den: int):
    """The rows (ROWS) of a slice: ``members`` are the set's shared tokens where they are enough for a link."""

    def split(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        n = len(raw) // (8 + PLACE_BYTES)
        return unpacked(raw[: 8 * n], 8), unpacked(raw[8 * n :], PLACE_BYTES)

    def run(table: pa.Table) -> pa.Table:
        docs = _flat(table.column("docs"))
        got = [split(x) for name in ("cells", "direct") for x in table.column(name).to_pylist() if x]
        token = np.concatenate([np.zeros(0, np.uint64), *[t for t, _ in got]])
        place = np.concatenate([np.zeros(0, np.uint64), *[p for _, p in got]])
        waiting = [split(x) for x in table.column("waiting").to_pylist() if x]
        if waiting:
            asked = token[place == SEVERAL]
            for t, p in waiting:
                mine = np.isin(t, asked)
                token, place = np.append(token, t[mine]), np.append(place, p[mine])
            token, place = token[place != SEVERAL], place[place != SEVERAL]
        order = np.lexsort((token, place))
        token, place = token[order], place[order]
        n, at = docs.field("n").to_numpy(), docs.field("at").to_numpy()
        a, b = np.searchsorted(place, at.clip(0).astype(np.uint64), "left"), np.searchsorted(place, at.clip(0).astype(np.uint64), "right")
        enough = (at >= 0) & (n > 0) & (den * (b - a) >= num * n)
        members = [token[x:y].tobytes() if ok else None for x, y, ok in zip(a.tolist(), b.tolist(), enough.tolist())]
        return pa.table({**{c: docs.field(c) for c in ("id", "n", "k1", "k2")}, "members": pa.array(members, pa.binary())})

    return run


def _flat(column: pa.ChunkedArray) -> pa.StructArray:
    found = [x.flatten() for x in column.chunks]
    return pa.concat_arrays(found) if found else pa.array([], DOCS.value_type)


def shared_tokens(cells: DataFrame, bits: int, num: int, den: int, owners: bool) -> DataFrame:
    """(id, n, k1, k2, members) for the sets in ``cells`` (CELLS).

    ``members`` are the set's tokens (sorted unsigned 64-bit numbers) that
    another set, or another owner's, holds too; null if they are fewer than the
    similarity ``num / den`` needs: such a set links with nothing.
    """
    spark = cells.sparkSession
    tasks = min(max(1 << bits, int(spark.conf.get("spark.sql.shuffle.partitions"))), 50_000)
    answers = cells.repartition(tasks, "part").groupBy("part").applyInArrow(trimmed(_answered(bits, owners)), _ANSWERS)
    return answers.groupBy("slice").applyInArrow(trimmed(_met(num, den)), ROWS)


def members_dealt(bits: int):
    """mapInArrow from (cid, n, key, owner, members) to CELLS with owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from revscope.llm._segments import lean, slices, trim

        lean()

        number = 0
        for batch in batches:
            for part in slices(batch, "members", 32 << 20):
                for low in range(0, part.num_rows, MOST_SETS):
                    rows = part.slice(low, MOST_SETS)
                    sets = [np.frombuffer(x, "<u8") for x in rows.column("members").to_pylist()]
                    sizes = np.array([len(s) for s in sets], np.int64)
                    place = np.repeat(np.arange(len(sets), dtype=np.uint64), sizes)
                    owner = np.repeat(rows.column("owner").to_numpy().view(np.uint64), sizes)
                    docs = pa.StructArray.from_arrays(
                        [rows.column("cid"), rows.column("n"), rows.column("key"), rows.column("owner"), pa.array(np.arange(len(sets)), pa.int32())], ["id", "n", "k1", "k2", "at"]
                    )
                    yield dealt((TaskContext.get().partitionId() << 24) + number, docs, np.concatenate(sets), place, owner, bits)
                    number += 1
        trim()

    return run


def part_bits(tokens: int, each: int = 1_000_000) -> int:
    """Bits that choose a token's part, for about ``each`` tokens a part."""
    return min(18, max(1, (tokens // each).bit_length()))


def token_count(texts: DataFrame) -> int:
    """About how many tokens ``texts`` (column text) have: a word is some six bytes."""
    return (texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6
