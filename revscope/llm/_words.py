"""Words, shingles and connected components, for the operators that compare texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import staged

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mixing of 64-bit numbers; other salts, other mixings."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: A-Z in lower case, ASCII white space as spaces; the other bytes as they are.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[9:14] = 32


def split_words(texts: pa.Array) -> pa.Array:
    """Lists of the pieces between ASCII white space (empty ones too), A-Z lower-cased.

    Arrow's own split at white space reads past its input; the one at a pattern does not.
    """
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    plain = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(bounds - bounds[0]), pa.py_buffer(_PLAIN[data]))
    return pc.split_pattern(plain, " ")


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs without ASCII white space, A-Z lower-cased), and text offsets."""
    import xxhash

    parts = split_words(texts)
    offsets = parts.offsets.to_numpy()
    coded = parts.flatten().dictionary_encode()
    offsets = offsets - offsets[0]
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    index = coded.indices.to_numpy()
    empty = [i for i, w in enumerate(words) if not w]
    if empty:
        real = index != empty[0]
        ends = np.concatenate([[0], np.cumsum(real)])
        index, offsets = index[real], ends[offsets]
    return hashes[index], offsets


def shingle_hashes(hashes: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, and offsets; a shorter text is one run."""
    counts = np.diff(offsets)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(runs)])
    starts = np.repeat(offsets[:-1] - ends[:-1], runs) + np.arange(int(ends[-1]))
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    left = np.repeat(counts, runs)
    out = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            word = padded[starts + k]
            if k:
                word = np.where(left > k, word, np.uint64(0))  # a word that a short text lacks
            out = mix(out * _ODD + word)
    return out, ends


def components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of an edge.

    Large-star and small-star steps in turn, each written to the shared folder;
    what reaches the driver is one row of counts a round.
    """
    wide = F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")
    now = staged(edges.filter(F.col(src) != F.col(dst)).select(*wide).distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = staged(both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if (after := mark(now)) == seen:
            break
        seen = after
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component"))
    )
