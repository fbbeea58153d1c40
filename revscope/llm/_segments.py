"""Cut texts into segments that a byte-level BPE encodes independently, each distinct one once.

The split pattern of the vocabularies always starts a new match at a space that
is followed by a character other than white space.  So a text's ids are its
segments' ids one after another, and a batch needs the ids of its distinct
segments only.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A space before white space or the end: such texts are not cut at every space.
_LOOSE = r" ([\t-\r\x1c-\x1f\x{85}\p{Z}]|$)"
_CUT = re.compile(r" (?=\S)")
_LATIN = "".join(c for c in map(chr, range(256)) if c.isalpha() and (c < "\x80" or c >= "\xc0"))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``start .. start+length-1``, run after run."""
    ends = np.cumsum(lengths)
    out = np.arange(int(ends[-1]) if len(ends) else 0, dtype=np.int64)
    return out + np.repeat(starts - (ends - lengths), lengths)


def lean() -> None:
    """Give memory back at once: Arrow's own pool keeps what a worker once used."""
    pa.set_memory_pool(pa.system_memory_pool())


def trim() -> None:
    """At a task's end: pages that the C library keeps free go back to the system, so an idle worker holds none."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library only
        give_back(0)


def trimmed(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` for a group of rows, with a ``trim`` once the group's result is made."""

    def each(table: pa.Table) -> pa.Table:
        out = run(table)
        trim()
        return out

    return each


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of about ``most`` bytes of ``column``, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at, n = 0, batch.num_rows
    ends = np.cumsum(lengths, dtype=np.int64)
    while at < n:
        done = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield batch.slice(at, to - at)
        at = to
        pa.default_memory_pool().release_unused()


class Vocabulary:
    """Ids of segments; those of a segment's leading word and of the rest are kept apart
    (what follows a run of letters starts a new match of the split pattern).

    ``encode(parts)`` returns the ids of all parts in one array and the count
    of each.  A part once encoded is remembered; when over ``most`` are, the
    next lookup starts anew, so memory is bounded by ``most`` and one batch.
    """

    def __init__(self, encode: Callable, most: int = 300_000, dtype=np.uint16):
        self.encode, self.most, self.dtype = encode, most, dtype
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.pool = np.zeros(1 << 16, self.dtype)
        self.ends = np.zeros(1 << 14, np.int64)  # of part i in the pool, at i + 1
        self.used = 0

    def _remember(self, parts: list[str]) -> None:
        ids, counts = self.encode(parts)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        first = len(self.known)
        while first + len(parts) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.pool[self.used : self.used + len(ids)] = ids
        self.ends[first + 1 : first + 1 + len(parts)] = self.used + np.cumsum(counts)
        self.used += len(ids)
        self.known.update(zip(parts, range(first, first + len(parts))))

    def lookup(self, segments: pa.Array, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, starts, counts): the ids of ``segments[i]`` are ``pool[starts[i]:starts[i]+counts[i]]``.

        ``cuts``: bytes of each segment's leading word.
        """
        if len(self.known) > self.most:
            self._clear()
        bounds = np.frombuffer(segments.buffers()[1], np.int64)[segments.offset :][: len(segments) + 1]
        both = np.empty(2 * len(segments) + 1, np.int64)
        both[::2] = bounds
        both[1::2] = bounds[:-1] + cuts
        parts = pa.LargeStringArray.from_buffers(len(both) - 1, pa.py_buffer(both), segments.buffers()[2])
        coded = parts.dictionary_encode()
        names, known = coded.dictionary.to_pylist(), self.known
        if new := [x for x in names if x not in known]:
            self._remember(new)
        at = np.fromiter(map(known.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
        starts = self.ends[at]
        counts = self.ends[at + 1] - starts
        pool = self.pool[ragged(starts, counts)]
        counts = counts.reshape(-1, 2).sum(axis=1)
        return pool, np.cumsum(counts) - counts, counts


def _letters(words: pa.Array) -> np.ndarray:
    """Bytes of the Latin letters that each word starts with; 0 if more than ASCII follows them."""
    rest = pc.utf8_ltrim(words, characters=_LATIN)
    left = pc.binary_length(rest).to_numpy()
    letters = pc.binary_length(words).to_numpy() - left
    bounds = np.frombuffer(rest.buffers()[1], np.int64)[rest.offset :][: len(rest)]
    data = np.frombuffer(rest.buffers()[2] or b"", np.uint8)
    wide = left > 0
    wide[wide] = data[bounds[wide]] > 127
    return np.where(wide, 0, letters)


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All segments without the space before them, and where each text's segments start."""
    loose = pc.match_substring_regex(texts, _LOOSE).to_numpy(zero_copy_only=False)
    texts = texts.cast(pa.large_string())
    if not loose.any():
        parts = pc.split_pattern(texts, " ")
        return parts.flatten(), parts.offsets.to_numpy()
    rows = texts.to_pylist()
    lists = [_CUT.split(t) if odd else t.split(" ") for t, odd in zip(rows, loose.tolist())]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return pa.array([s for x in lists for s in x], pa.large_string()), offsets


def token_ids(texts: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``texts`` one after another, and the count of each text's."""
    n = len(texts)
    if not n:
        return np.zeros(0, vocabulary.dtype), np.zeros(0, np.int64)
    words, offsets = _pieces(texts)
    offsets = offsets - offsets[0]
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    spaced = coded.dictionary
    # a text's first segment has no space before it
    opening = words.take(pa.array(offsets[:-1])).dictionary_encode()
    index[offsets[:-1]] = len(spaced) + opening.indices.to_numpy()
    after_space = pc.binary_join_element_wise(pa.scalar("", spaced.type), spaced, pa.scalar(" ", spaced.type))
    letters = _letters(spaced)
    cuts = np.concatenate([letters + (letters > 0), _letters(opening.dictionary)])
    pool, starts, counts = vocabulary.lookup(pa.concat_arrays([after_space, opening.dictionary]), cuts)
    runs = counts[index]
    ids = pool[ragged(starts[index], runs)]
    ends = np.concatenate([[0], np.cumsum(runs)])
    return ids, np.diff(ends[offsets])
