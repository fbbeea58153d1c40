"""MinHash near-dedup against all pairs."""

import random

import numpy as np
import pytest

from revscope.llm import _matrix, lsh_forest
from test_jaccard import brute, families


@pytest.mark.parametrize("near,sets,parts", [(4, 768, 1), (1, 4, 5)])
def test_components_equal_all_pairs(spark, monkeypatch, near, sets, parts):
    """Also where regions are larger than the neighbours that are met, and families larger than a group."""
    monkeypatch.setattr(lsh_forest, "NEAR", near)
    monkeypatch.setattr(_matrix, "GROUP_SETS", sets)
    rows = families(near, many=8)
    found = lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 5, 85, 100)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.ids) for r in awkward.select("doc_id", "ids").collect()]
    want = brute([x for x in rows if x[0] is not None], 5, 85, 100)
    found = lsh_forest.near_duplicates(awkward).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.kept == (r.doc_id == r.component_id)
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]


def test_rows_that_repeat_an_id_are_one_node(spark):
    r = random.Random(3)
    one, two = ([f"{x}{r.random()}" for _ in range(60)] for x in "ab")
    rows = [(5, " ".join(one)), (5, " ".join(two)), (7, " ".join(one + ["x"])), (9, " ".join(two + ["y"])), (11, "a b c d e f g")]
    found = {x.doc_id: x.component_id for x in lsh_forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {5: 5, 7: 5, 9: 5, 11: 11}


def test_empty_table(empty):
    assert lsh_forest.near_duplicates(empty).count() == 0


def test_signatures_estimate_the_similarity():
    r = np.random.default_rng(4)
    n, agree = 170, []
    for _ in range(60):
        common = r.integers(0, 2**63, n).astype(np.uint64)
        sets = [np.sort(np.append(common, r.integers(0, 2**63, 15).astype(np.uint64))) for _ in range(2)]
        values = lsh_forest.signatures(np.concatenate(sets), np.array([n + 15, n + 15]))
        agree.append((values[0] == values[1]).mean())
        roots = values.reshape(2, lsh_forest.TREES, lsh_forest.DEPTH)[:, :, : lsh_forest.ROOT]
        assert (roots[0] == roots[1]).all(axis=1).any()  # 170 / 200: a region in common
    assert abs(np.mean(agree) - 0.85) < 0.01 and min(agree) > 0.65


def test_neighbours_meet_across_batches_and_large_regions_are_reported():
    import pyarrow as pa

    rows = sorted((t, root, d, 10 * t + d) for t, root, many in ((0, 1, 3), (0, 2, 1), (1, 1, 9), (1, 5, 2), (2, 2, 4)) for d in range(many))
    table = pa.record_batch({n: [x[i] for x in rows] for i, n in enumerate(("tree", "root", "deep", "key"))}, pa.schema([("tree", pa.int32()), *[(n, pa.int64()) for n in ("root", "deep", "key")]]))
    want = None
    for step in (100, 1, 4):
        out = [x for b in lsh_forest._neighbours(2)(table.slice(i, step) for i in range(0, len(rows), step)) for x in b.to_pylist()]
        pairs = sorted((x["a"], x["b"]) for x in out if x["b"] is not None)
        wide = sorted(x["a"] for x in out if x["b"] is None)
        assert want is None or want == (pairs, wide)
        want = pairs, wide
    # both ends of a range may go on in another: their regions are reported whatever their size
    assert want[1] == sorted([0, 1, 2, *range(10, 19), 20, 21, 22, 23])
    assert (0, 2) in want[0] and (10, 13) not in want[0]
