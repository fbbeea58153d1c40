"""Operator 9, byte-level BPE: encoding by merge replay over a corpus of words, and decoding.

Method: the distinct words of a large slice of a partition's texts form one
corpus of byte symbols.  An inverted index leads from a mergeable pair (keyed by
the rank it merges to) to the positions where it stands; the smallest rank is
taken again and again, all its positions are merged from left to right, and
only the pairs with the two touched neighbours enter the index.  A word's ids
are looked up wherever the word occurs.

Where a merge creates a pair of a smaller rank than its own, replay over all
words could differ from the order within one word; such words are encoded
again, one by one, in the defining order.

Words already replayed are remembered by the worker up to a bound, so memory
does not grow with the input; nothing is shuffled or sent to the driver.

Defined cases: null text counts as empty (no ids, digests of the empty string);
null, repeated or unordered doc ids are carried along; further columns are not
read; an empty table gives no rows.  Ids outside the table fail the decoding.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import pick, ship

SLICE_BYTES = 6 << 20
SPREAD = 1 << 32


class Ranks:
    """Tokens by rank, and the rank that each mergeable pair of ranks merges to."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        rank = {t: i for i, t in enumerate(tokens) if t}
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        self.pair: dict[int, int] = {}
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = rank.get(t[:k]), rank.get(t[k:])
                if a is not None and b is not None:
                    self.pair[a * SPREAD + b] = i
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def one(self, word: bytes) -> list[int]:
        """The defining order: the smallest rank first, the leftmost of equals."""
        symbols = self.byte[np.frombuffer(word, np.uint8)].tolist()
        while len(symbols) > 1:
            ranks = [self.pair.get(a * SPREAD + b, SPREAD) for a, b in zip(symbols, symbols[1:])]
            r = min(ranks)
            if r == SPREAD:
                break
            k = ranks.index(r)
            symbols[k : k + 2] = [r]
        return symbols

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and the count of each word's."""
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes)
        first = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        n = len(first)
        after = np.arange(1, n + 1)
        after[ends[sizes > 0] - 1] = -1
        before = np.arange(-1, n - 1)
        before[(ends - sizes)[sizes > 0]] = -1
        at = np.flatnonzero(after >= 0)
        pairs, which = np.unique(first[at] * SPREAD + first[at + 1], return_inverse=True)
        get = self.pair.get
        rank = np.array([get(p, -1) for p in pairs.tolist()], np.int64)[which]
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        heap, cuts = np.unique(rank[order], return_index=True)
        heap = heap.tolist()
        index = dict(zip(heap, (x.tolist() for x in np.split(at[order], cuts[1:])))) if heap else {}
        symbol, after, before = first.tolist(), after.tolist(), before.tolist()
        odd: list[int] = []
        while heap:
            r = heapq.heappop(heap)
            for i in sorted(index.pop(r)):
                a, j = symbol[i], after[i]
                if a < 0 or j < 0 or get(a * SPREAD + symbol[j]) != r:
                    continue
                symbol[i], symbol[j] = r, -1
                k, h = after[j], before[i]
                after[i] = k
                for left, p in ((i, r * SPREAD + symbol[k] if k >= 0 else -1), (h, symbol[h] * SPREAD + r if h >= 0 else -1)):
                    if (q := get(p)) is not None:
                        if q < r:
                            odd.append(i)
                        if (there := index.get(q)) is None:
                            index[q] = [left]
                            heapq.heappush(heap, q)
                        else:
                            there.append(left)
                if k >= 0:
                    before[k] = i
        ids = np.array(symbol, np.int64)
        alive = ids >= 0
        total = np.concatenate([[0], np.cumsum(alive)])
        counts = total[ends] - total[ends - sizes]
        ids = ids[alive]
        if odd:
            again = {int(w): self.one(words[w]) for w in np.unique(np.searchsorted(ends, odd, side="right"))}
            starts = np.cumsum(counts) - counts
            parts, done = [], 0
            for w, found in again.items():
                parts += [ids[done : starts[w]], np.array(found, np.int64)]
                done = starts[w] + counts[w]
                counts[w] = len(found)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids``, one token after another."""
        from revscope.llm._segments import ragged

        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


@cache
def load(path: str) -> Ranks:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        rows = [(base64.b64decode(a), int(b)) for a, b in map(bytes.split, lines)]
    tokens = [b""] * (max(r for _, r in rows) + 1)
    for token, r in rows:
        tokens[r] = token
    return Ranks(tokens)


@cache
def vocabulary(path: str, pattern: str):
    """Ids of segments by merge replay; kept by the worker for its later tasks."""
    import regex

    from revscope.llm._segments import Vocabulary

    ranks, split = load(path), regex.compile(pattern).findall

    def encode(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        matches = [[x] if x.isalpha() or x[0] == " " and x[1:].isalpha() else split(x) for x in parts]
        place: dict[str, int] = {}
        which = [place.setdefault(m, len(place)) for x in matches for m in x]
        ids, counts = ranks.replay([w.encode() for w in place])
        from revscope.llm._segments import ragged

        starts = np.cumsum(counts) - counts
        n = counts[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in matches])])
        return ids[ragged(starts[which], n)], np.diff(ends[bounds])

    return Vocabulary(encode, dtype=np.uint16 if len(ranks.tokens) <= 1 << 16 else np.uint32)


def _encoder(path: str, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import lean, slices, token_ids

        lean()
        vocab, ranks = vocabulary(path, pattern), load(path)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, counts = token_ids(part.column("text"), vocab)
                ends = np.concatenate([[0], np.cumsum(counts)])
                raw = memoryview(ids.astype("<u4")).cast("B")
                spans = [raw[4 * a : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(counts)}
                if digests:
                    text = memoryview(ranks.decode(ids))
                    at = np.concatenate([[0], np.cumsum(ranks.lengths[ids])])[ends].tolist()
                    columns["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in spans], pa.string())
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())
                else:
                    columns["ids"] = pa.array([bytes(x) for x in spans], pa.binary())
                yield pa.record_batch(columns)

    return run


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    ship(docs.sparkSession)
    return pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")
    )


def bpe_encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) of each document."""
    return _narrow(docs, id_col, text_col).mapInArrow(_encoder(path, pattern, False), "doc_id long, n_tokens long, ids binary")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of ``bpe_encode``; bytes that are no UTF-8 become U+FFFD."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path)
        for batch in batches:
            texts = [ranks.decode(np.frombuffer(x.as_buffer(), "<u4")).tobytes().decode(errors="replace") for x in batch.column("ids")]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": pa.array(texts, pa.string())})

    return encoded.select(F.col("doc_id").cast("long"), F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(run, "doc_id long, text string")


def bpe_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes decoded from them."""
    return _narrow(docs, id_col, text_col).mapInArrow(
        _encoder(path, pattern, True), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
