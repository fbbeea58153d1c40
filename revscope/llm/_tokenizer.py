"""Ids of a ``tokenizers`` vocabulary, one encoding for each distinct segment."""

from __future__ import annotations

import os
from functools import cache

import numpy as np

from revscope.llm._segments import Vocabulary, ragged

#: Segments joined into one text for the library; keeps its offsets small.
RUN = 8_000


def byte_lengths(tokens: dict[str, int]) -> np.ndarray:
    """Bytes of each id; a byte-level vocabulary writes each byte as one character."""
    out = np.zeros(max(tokens.values()) + 1, np.int64)
    for token, i in tokens.items():
        out[i] = len(token)
    return out


@cache
def vocabulary(path: str, most: int = 300_000) -> Vocabulary:
    """The vocabulary file's encoder; kept by the worker for its later tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    lengths = byte_lengths(tokenizer.get_vocab())
    dtype = np.uint16 if len(lengths) <= 1 << 16 else np.uint32

    def encode(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts that begin with a letter go in alone, all others joined into runs.

        A part that does not begin with a space and a visible character is set
        off by the word " a", whose one id is dropped again.
        """
        counts = np.zeros(len(parts), np.int64)
        letter = [x[0].isalnum() for x in parts]
        alone = [i for i, x in enumerate(letter) if x]
        joined = [i for i, x in enumerate(letter) if not x]
        found, order = [], []
        for at in range(0, len(joined), RUN):
            chosen = joined[at : at + RUN]
            texts = [parts[i] for i in chosen]
            off = np.array([not (len(x) > 1 and x[0] == " " and not x[1].isspace()) for x in texts])
            ids = np.array(
                tokenizer.encode_batch_fast(
                    ["".join(" a" + x if o else x for x, o in zip(texts, off.tolist()))], add_special_tokens=False
                )[0].ids,
                np.int64,
            )
            ends = np.cumsum([len(x.encode()) for x in texts] + 2 * off)
            cut = np.searchsorted(np.cumsum(lengths[ids]), ends) + 1
            n = np.diff(np.concatenate([[0], cut]))
            keep = np.ones(len(ids), bool)
            keep[(cut - n)[off]] = False
            found.append(ids[keep])
            counts[chosen] = n - off
            order += chosen
        for at in range(0, len(alone), RUN):
            chosen = alone[at : at + RUN]
            coded = [e.ids for e in tokenizer.encode_batch_fast([parts[i] for i in chosen], add_special_tokens=False)]
            counts[chosen] = [len(x) for x in coded]
            order += chosen
            found.append(np.array([i for x in coded for i in x], np.int64))
        ids = np.concatenate(found)
        if alone and joined:  # back into the order asked for
            placed = counts[order]
            starts = np.zeros(len(parts), np.int64)
            starts[order] = np.cumsum(placed) - placed
            ids = ids[ragged(starts, counts)]
        return ids.astype(dtype), counts

    return Vocabulary(encode, most, dtype)
