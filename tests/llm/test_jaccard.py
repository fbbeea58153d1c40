"""The Jaccard join against all pairs, and the pipeline's stages against brute force."""

import random
import re

import pytest

from revscope.llm import _matrix, jaccard
from revscope.llm._words import components


def brute(rows, size, num, den):
    """(set size, component) of each document, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def families(seed, many=6):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for _ in range(many):
        base = [r.choice(words) for _ in range(r.choice([12, 40, 90, 150]))]
        for _ in range(r.choice([2, 10, 30])):
            text = list(base)
            for _ in range(r.randint(0, max(1, len(base) // 30))):
                text[r.randrange(len(text))] = r.choice(words)
            rows.append(" ".join(text))
    rows += ["a b", "a  b", "A b", "", "  ", "a", "x y z", "x y z w", None]
    rows += [" ".join(r.choice(words) for _ in range(30)) for _ in range(15)]
    r.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("size,num,den,sets", [(3, 90, 100, 768), (3, 90, 100, 6), (5, 80, 100, 8)])
def test_components_equal_all_pairs(spark, monkeypatch, size, num, den, sets):
    monkeypatch.setattr(_matrix, "GROUP_SETS", sets)
    rows = families(size + sets)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size, num, den).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, size, num, den)


def test_awkward_rows(awkward):
    rows = [(r.doc_id, r.ids) for r in awkward.select("doc_id", "ids").collect()]
    want = brute([x for x in rows if x[0] is not None], 3, 90, 100)
    found = jaccard.jaccard_components(awkward).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
    left = jaccard.one_of_each(awkward)
    assert left.columns == awkward.columns
    assert {r.doc_id for r in left.select("doc_id").collect()} == {None} | {i for i, (_, c) in want.items() if c == i}


def test_components_of_chains_and_stars(spark):
    r = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 230)] + [(300, 300)] + [(r.randint(400, 420), r.randint(400, 420)) for _ in range(15)]
    parent = {}

    def root(i):
        parent.setdefault(i, i)
        return i if parent[i] == i else root(parent[i])

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = {x.node: x.component for x in components(spark.createDataFrame(edges, "src long, dst long"), "src", "dst").collect()}
    assert found == {i: root(i) for a, b in edges if a != b for i in (a, b)}


def test_empty_table(empty):
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.one_of_each(empty).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = docs
        if name != "packing":
            assert docs.columns == before.columns
    text = lambda name: {r.doc_id: r.text for r in kept[name].collect()}
    first = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert text("language_id") == first  # every document here is in one of the four languages
    unique = {}
    for i in sorted(first):
        unique.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", first[i]), i)
    assert set(text("exact_dedup")) == set(unique.values())
    near = brute(sorted(text("exact_dedup").items()), 5, 80, 100)
    assert set(text("jaccard_join")) == {i for i, (_, c) in near.items() if c == i}
    clean = text("secret_scan")
    assert set(clean) == set(text("jaccard_join"))
    assert not any(re.search(r"[0-9a-f]{24,}", t) for t in clean.values())
    assert {r.doc_id for r in kept["packing"].collect()} == set(clean)
    assert corpus_pipeline.run(spark, folder).count() == kept["packing"].count()
