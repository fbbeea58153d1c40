"""Packing, token files and byte-level BPE against the public libraries, whole texts."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from revscope.llm import bpe, packing, token_files
from revscope.llm._common import new_folder
from revscope.llm._segments import token_ids
from revscope.llm._tokenizer import vocabulary

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n=3000):
    r = random.Random(1)
    alphabet = "ab eno's .,1é²½ж\n\t 　\xa0日本\x1c\x85́—…😀'll"
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 50))) for _ in range(n)] + ["a" * 70, "<|endoftext|>", " "]


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[a:b].tolist() for a, b in zip(ends - counts, ends)]


def test_segments_give_the_librarys_ids(tokenizer):
    texts = random_texts()
    assert split(*token_ids(pa.array(texts), vocabulary(JSON))) == [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_a_full_cache_starts_anew(tokenizer):
    vocab = vocabulary(JSON, 50)
    for texts in (random_texts(300), random_texts(400)):
        assert split(*token_ids(pa.array(texts), vocab)) == [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_merge_replay_equals_the_library(reference):
    texts = random_texts()
    assert split(*token_ids(pa.array(texts), bpe.vocabulary(RANKS, P.PATTERN))) == [reference.encode_ordinary(t) for t in texts]


def test_words_of_smaller_new_ranks_are_encoded_in_the_defining_order():
    # merging b c (4) makes a|bc whose pair has the smaller rank 3
    table = bpe.Ranks([bytes([b]) for b in range(256)] + [b"abc", b"bc", b"bcb", b"cb"])
    words = [b"abcbc", b"bcbc", b"abc", b"cbcbcb", b"", b"x"]
    ids, counts = table.replay(words)
    assert split(ids, counts) == [table.one(w) for w in words]


def test_bpe_round_trip(awkward, spark, reference):
    encoded = bpe.bpe_encode(awkward, RANKS, P.PATTERN)
    want = {r.doc_id: r.ids or "" for r in awkward.select("doc_id", "ids").collect() if r.doc_id is not None}
    got = {r.doc_id: r for r in encoded.collect() if r.doc_id is not None}
    back = {r.doc_id: r.text for r in bpe.bpe_decode(encoded, RANKS).collect() if r.doc_id is not None}
    digests = {r.doc_id: r for r in bpe.bpe_digests(awkward, RANKS, P.PATTERN).collect() if r.doc_id is not None}
    for i, text in want.items():
        ids = reference.encode_ordinary(text)
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids and got[i].n_tokens == len(ids)
        assert back[i] == text
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_coding_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 1001):
        ranks = (2 ** r.uniform(0, 31.9, n)).astype(np.uint32)
        assert token_files.decode_ranks(*token_files.encode_ranks(ranks), n).tolist() == ranks.tolist()


def test_token_files(awkward, spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCKS_A_FILE", 1)
    folder = new_folder(spark, "test")
    found = sorted(token_files.token_files(awkward, JSON, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted([r.doc_id for r in found], key=lambda i: -1 if i is None else i)
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    texts = {i: t for i, t in ((r.doc_id, r.ids) for r in awkward.select("doc_id", "ids").collect()) if i is not None}
    read = {r.doc_id: r.ids for r in token_files.read_tokens(spark, folder).collect()}
    for r in found:
        if r.doc_id is not None:
            ids = np.array(tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0], "<u4")
            assert read[r.doc_id] == ids.tobytes() and r.ids_crc32 == zlib.crc32(ids.tobytes())


def test_differencing_keeps_windows_near_equal():
    r = np.random.default_rng(0)
    sizes = r.integers(1, 129, 4000)
    at = packing.windows_of(sizes, 1024)
    sums = np.bincount(at, weights=sizes)
    assert sums.max() <= 1024 and sums.sum() / 1024 / len(sums) > 0.98
    assert packing.windows_of(np.array([700, 700, 700]), 1024).tolist() in ([0, 1, 2], [2, 1, 0], [0, 2, 1], [1, 0, 2], [1, 2, 0], [2, 0, 1])


@pytest.mark.parametrize("block", [4096, 16])
def test_packing(awkward, tokenizer, block):
    rows = packing.pack(awkward, JSON, block=block, with_ids=True).collect()
    texts = sorted((t or "" for _, t in ((r.doc_id, r.ids) for r in awkward.select("doc_id", "ids").collect())))
    want = sorted(tuple(tokenizer.encode(t, add_special_tokens=False).ids + [0]) for t in texts)
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    for members in by_sequence.values():
        members.sort(key=lambda r: r.offset)
        assert [r.offset for r in members] == np.cumsum([0] + [r.length for r in members[:-1]]).tolist()
        assert sum(r.length for r in members) <= 1024
    assert sum(r.length for r in rows) == sum(map(len, want))
    for i, pieces in by_doc.items():
        if i not in (None, 9):  # repeated ids
            pieces.sort(key=lambda r: r.start)
            assert tuple(np.frombuffer(b"".join(r.ids for r in pieces), "<u4")) in want


def test_sequences_are_padded(awkward, spark):
    pieces = packing.pack(awkward, JSON, with_ids=True)
    sizes = {r.sequence_id: r["sum(length)"] for r in pieces.groupBy("sequence_id").sum("length").collect()}
    for r in packing.sequences(pieces).collect():
        n = sizes[r.sequence_id]
        assert r.tokens == n and len(r.ids) // 4 == (n if n & (n - 1) == 0 else 1024)


def test_empty_tables(empty):
    assert packing.pack(empty, JSON).count() == 0
    assert token_files.token_files(empty, JSON).count() == 0
    assert bpe.bpe_digests(empty, RANKS, P.PATTERN).count() == 0


def test_ids_are_summed_up_where_they_are_decoded(spark, monkeypatch):
    """No second Python pass over the decoded ids."""
    plans, plain = {}, token_files.staged

    def spy(df, label):
        plans[label] = df._jdf.queryExecution().sparkPlan().toString()
        return plain(df, label)

    monkeypatch.setattr(token_files, "staged", spy)
    rows = token_files.token_files(spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string"), JSON).collect()
    assert [(r.doc_id, r.start) for r in sorted(rows)][0] == (1, 0) and len(rows) == 2
    assert plans["token-index"].count("MapInArrow") == 1
