"""Ranked lexical search against scoring every document for every item."""

import math
import random
import re

import numpy as np
import pytest

from revscope.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, k):
    """{item: [(doc, score)]}: each document scored as the contract says."""
    held = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = {}
    for i, q in asked.items():
        rows = []
        for d, t in held:
            if t:
                m = 100 - 50 + (50 * len(t) * n_docs) // n_terms
                score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((1000000000 * t.count(x)) // (1000 * t.count(x) + 20 * m)) for x in q if x in df and x in t)
                if score > 0:
                    rows.append((-score, d is None, d or 0, d))
        rows.sort()
        out[i] = [(r[3], -r[0]) for r in rows[:k]]
    return {i: x for i, x in out.items() if x}


def got(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.item_id, r["rank"])):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


@pytest.mark.parametrize("k,parts,block", [(50, 1, 10**6), (3, 7, 10**6), (5, 4, 40)])
def test_equals_scoring_everything(spark, k, parts, block):
    r = random.Random(k)
    words = [f"w{i}" for i in range(60)] + ["Éa", "日本", "x9"]
    heavy = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, r.choice([" ", ", ", "-"]).join(r.choices(words, heavy, k=r.choice([1, 4, 30, 200])))) for i in range(400)]
    items = [(i, " ".join(r.sample(words, r.randint(1, 12)))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked_search.search(frame, asked, k, block_terms=block)) == brute(docs, items, k)


def test_awkward_rows(spark, awkward):
    docs = [(r.doc_id, r.ids) for r in awkward.collect()]
    items = [(1, docs[9][1][:80]), (1, "one AND two"), (2, None), (3, "zzzz"), (4, "It's 12"), (4, "It's 12"), (5, "no id")]
    asked = spark.createDataFrame([(i, t, 0, "x") for i, t in items], "item_id long, text string, rank int, TEXT string")
    assert got(ranked_search.search(awkward, asked)) == brute(docs, items, 50)


def test_empty_tables(spark, empty):
    asked = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.search(empty, asked).count() == 0
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert ranked_search.search(docs, asked.limit(0)).count() == 0
    assert ranked_search.search(docs, asked).count() == 1


def test_accumulators_are_limited_and_scores_exact():
    """A rare term fills the first k; then the frequent one makes no accumulator but still counts."""
    n = 1000
    row = {
        "docs": list(range(n)), "lengths": [10] * n, "terms": [0, 1], "counts": [5, n],
        "at": [*range(5), *range(n)], "tf": [3] * 5 + [1] * n,
    }
    import pyarrow as pa

    part = ranked_search.Slice(lambda name: pa.array(row[name], pa.int64()), n, 10 * n)
    found, score, made = ranked_search.accumulate(part, [(0, 5000), (1, 1)], 5, 0)
    assert made == 5 and found.tolist() == [0, 1, 2, 3, 4]
    gain = lambda tf: (1000000000 * tf) // (1000 * tf + 20 * 100)
    assert np.all(score == 5000 * gain(3) + gain(1))
    _, _, everything = ranked_search.accumulate(part, [(0, 5000), (1, 1)], 6, 0)
    assert everything == n
