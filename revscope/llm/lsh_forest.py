"""Operator 12, MinHash near-dedup with an LSH forest.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of 0.85 or more (compared exactly, on full sets).

Method.
1. One pass over the texts makes each set's size, digest (equal sets are one
   class) and signature: ``TREES * DEPTH`` MinHash values of 16 bits.
2. The forest: in each tree, the classes are sorted by the tree's ``DEPTH``
   values, a range of that order a task, so a region of equal classes may lie
   in several tasks.  Two classes are in one region if their first ``ROOT``
   values agree; inside it the neighbours in the order, which have the longest
   common prefixes, are candidates: each class meets the ``NEAR`` that follow it,
   so in a region of up to ``NEAR + 1`` all meet all, and in a larger one each
   meets those of the greatest common depth, however deep that is.
3. Candidates whose signatures agree on too few values for a link are dropped.
   What is left connects classes into families.  A family of bounded size is
   compared at once on full sets, by a matrix of members by shingles.
4. The exact way for the rest: regions of more than ``NEAR + 1`` classes that
   are not one family, and families above a group's size, are compared by the
   token-group matrix of ``_matrix`` on full sets, without any bound on
   partners.

What can be lost is a link whose classes share a region in none of the trees:
at the threshold itself with a probability of (1 - 0.85^4)^24 = 2e-8 a link, less
above it; and one that the signatures put below ``FLOOR`` (1e-11).  A link lost
that way matters only if no other path of links joins the two documents.

Defined cases: null text counts as empty; a document without words has an empty
set, links with nothing and is kept; one with fewer than five words has its
whole sequence as one shingle; very long texts are one set, whole; equal texts
are one class; rows that repeat a doc id are one node of the links; a text that
only rows without doc id have gets a null component, is kept, and passes no link
on; repeated rows each get a row; further columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revscope.llm import _matrix
from revscope.llm._common import pick, ship, staged
from revscope.llm._words import components, mix
from revscope.llm.jaccard import SLICE_BYTES, components_of, digests, firsts, node_edges, text_sets

SIZE = 5
#: The similarity as a fraction: a link when ``DEN * intersection >= NUM * union``.
NUM, DEN = 85, 100
#: Trees, values of a tree's order, values that make a region, neighbours that a class meets.
TREES, DEPTH, ROOT, NEAR = 24, 8, 4, 4
#: Deviations that a candidate's signature may lie below the threshold.
DEVIATIONS = 8.0

_ODD = mix(np.arange(TREES * DEPTH, dtype=np.uint64), 77) | np.uint64(1)
ROWS = "id long, n long, k1 long, k2 long, signature binary"


def signatures(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` MinHash values of 16 bits for each set (none empty)."""
    out = np.empty((len(sizes), len(_ODD)), np.uint16)
    starts = np.cumsum(sizes) - sizes
    mixed = mix(tokens, 5)
    with np.errstate(over="ignore"):
        # some sets at a time, so that the numbers stay in the processor's cache
        for low in range(0, len(sizes), 64):
            high = min(low + 64, len(sizes))
            a, b = int(starts[low]), int(starts[high - 1] + sizes[high - 1])
            part, at = mixed[a:b], starts[low:high] - a
            for j, odd in enumerate(_ODD):
                out[low:high, j] = np.minimum.reduceat(part * odd, at) & np.uint64(0xFFFF)
    return out


def _signed(size: int):
    """Size and digest of each document's set, and the signature of the first of its kind in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import slices

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, sizes = text_sets(part.column("text"), size)
                d1, d2 = digests(tokens, sizes)
                kept = firsts(sizes, d1, d2)
                signed = iter(signatures(tokens[np.repeat(kept, sizes)], sizes[kept]))
                column = pa.array([next(signed).tobytes() if k else None for k in kept.tolist()], pa.binary())
                yield pa.record_batch({"id": part.column("doc_id"), "n": pa.array(sizes), "k1": pa.array(d1), "k2": pa.array(d2), "signature": column})

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and tree: the tree's values as two sort keys."""
    for batch in batches:
        for low in range(0, batch.num_rows, 4096):
            part = batch.slice(low, 4096)
            values = np.frombuffer(b"".join(part.column("signature").to_pylist()), "<u2").reshape(-1, TREES, DEPTH)
            keys = values.astype(">u2").copy().view(">i8").astype(np.int64).reshape(-1, 2)
            tree = np.tile(np.arange(TREES, dtype=np.int32), part.num_rows)
            yield pa.record_batch({"tree": tree, "root": keys[:, 0], "deep": keys[:, 1], "key": np.repeat(part.column("key").to_numpy(), TREES)})


PAIRS = "a long, b long, region long"


def _neighbours(near: int):
    """Candidates (a, b) of a sorted range of the orders: each class with the ``near`` that follow in its region.

    The members of regions of more than ``near + 1``, and of those that the
    range cuts, come as (a, null, region).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        opening = True  # the first region of the range may have begun in the one before

        def found(tree, root, key, whole: np.ndarray):
            """Rows of complete runs of equal (tree, root)."""
            starts = np.flatnonzero(np.concatenate([[True], (tree[1:] != tree[:-1]) | (root[1:] != root[:-1]), [True]]))
            size = np.repeat(np.diff(starts), np.diff(starts))
            run_of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for step in range(1, near + 1):
                same = np.flatnonzero(run_of[step:] == run_of[:-step])
                a.append(key[same])
                b.append(key[same + step])
            wide = (size > near + 1) | ~whole
            region = mix(root.view(np.uint64), 9) ^ mix(tree.astype(np.uint64), 10)
            a, b = np.concatenate(a), np.concatenate(b)
            none = pa.nulls(int(wide.sum()), pa.int64())
            yield pa.record_batch({"a": a, "b": b, "region": pa.nulls(len(a), pa.int64())})
            yield pa.record_batch({"a": key[wide], "b": none, "region": region[wide].view(np.int64)})

        for batch in batches:
            now = [batch.column(c).to_numpy() for c in ("tree", "root", "key")]
            held = now if held is None else [np.concatenate([x, y]) for x, y in zip(held, now)]
            tree, root, key = held
            last = int(np.flatnonzero((tree != tree[-1]) | (root != root[-1])).max(initial=-1)) + 1
            if last:  # the last run may go on in the next batch
                whole = np.ones(last, bool)
                if opening:
                    whole[(tree[:last] == tree[0]) & (root[:last] == root[0])] = False
                opening = False
                yield from found(tree[:last], root[:last], key[:last], whole)
                held = [x[last:] for x in held]
            elif len(key) > 1 << 20:  # a region of any size keeps only what the next rows meet
                yield from found(tree, root, key, np.zeros(len(key), bool))
                held, opening = [x[-near:] for x in held], True
        if held is not None:
            yield from found(*held, np.zeros(len(held[0]), bool))

    return run


def _likely(least: int):
    """Candidates whose signatures agree on at least ``least`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1) for c in ("one", "two"))
            keep = pa.array((one == two).sum(axis=1) >= least)
            yield pa.record_batch({"src": batch.column("a"), "dst": batch.column("b")}).filter(keep)

    return run


def _fetched(size: int):
    """The sets of the classes asked for, from the text of their first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import slices

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, sizes = text_sets(part.column("text"), size)
                d1, d2 = digests(tokens, sizes)
                own = (d1 == part.column("k1").to_numpy()) & (d2 == part.column("k2").to_numpy())  # not another text of that id
                ends = np.cumsum(sizes)
                members = [tokens[a:b].tobytes() for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                columns = {"cid": part.column("cid"), "n": pa.array(sizes), "key": part.column("k1"), "members": pa.array(members, pa.binary())}
                yield pa.record_batch(columns | {n: part.column(n) for n in ("family", "rest")}).filter(pa.array(own))

    return run


def forest_candidates(classes: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(src, dst) candidates and (key, region) of large regions, for ``classes`` (key, signature)."""
    orders = staged(classes.select("key", "signature").mapInArrow(_places, "tree int, root long, deep long, key long"), "orders")
    tasks = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = orders.repartitionByRange(tasks, "tree", "root", "deep", "key").sortWithinPartitions("tree", "root", "deep", "key")
    met = staged(ranges.mapInArrow(_neighbours(NEAR), PAIRS), "neighbours")
    pairs = met.filter("b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = [classes.select(F.col("key").alias(x), F.col("signature").alias(y)) for x, y in (("a", "one"), ("b", "two"))]
    both = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "one", "two")
    share = num / den
    least = int(np.floor(TREES * DEPTH * share - DEVIATIONS * (TREES * DEPTH * share * (1 - share)) ** 0.5))
    return staged(both.mapInArrow(_likely(least), "src long, dst long"), "candidates"), met.filter("b is null").select(F.col("a").alias("key"), "region")


def near_duplicates(docs: DataFrame, size: int = SIZE, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc id reachable by links), kept."""
    ship(docs.sparkSession)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = staged(narrow.mapInArrow(_signed(size), ROWS), "signed")
    classes = rows.filter("n > 0").groupBy("k1", "k2").agg(F.min("id").alias("first_id"), F.first("signature", ignorenulls=True).alias("signature"))
    classes = staged(classes.withColumn("key", F.col("k1")), "classes")
    named = classes.filter("first_id is not null")
    candidates, wide = forest_candidates(named, num, den)
    families = staged(components(candidates, "src", "dst"), "families")
    # classes of large regions that are not one family, and of large families: compared with no bound on partners
    placed = wide.join(families, wide["key"] == families["node"], "left").select("key", "region", F.coalesce("component", "key").alias("family"))
    mixed = placed.groupBy("region").agg(F.min("family").alias("low"), F.max("family").alias("high")).filter("low <> high").select("region")
    rest = placed.join(mixed, "region", "left_semi").select("key")
    weights = families.join(named.select("key", "k1", "k2"), families["node"] == named["key"]).join(rows.select("k1", "k2", "n").dropDuplicates(["k1", "k2"]), ["k1", "k2"])
    large = weights.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens"))
    large = large.filter((F.col("sets") > _matrix.GROUP_SETS) | (F.col("tokens") > _matrix.GROUP_TOKENS)).select("component")
    large = families.join(large, "component", "left_semi").select(F.col("node").alias("key"), F.lit(True).alias("large"))
    rest = rest.unionByName(large.select("key")).distinct().withColumn("rest", F.lit(True))
    asked = families.select(F.col("node").alias("key"), F.col("component").alias("family")).join(rest, "key", "full_outer").join(large, "key", "left")
    asked = asked.select("key", F.when(F.col("large").isNull(), F.col("family")).alias("family"), F.coalesce("rest", F.lit(False)).alias("rest"))
    wanted = staged(asked.join(named.select("key", "k1", "k2", F.col("first_id").alias("cid")), "key"), "asked")
    texts = narrow.join(wanted.select("cid", "k1", "k2", "family", "rest").hint("merge"), narrow["doc_id"] == F.col("cid")).drop("doc_id")
    sets = staged(texts.mapInArrow(_fetched(size), f"{_matrix.SET}, family long, rest boolean").dropDuplicates(["key", "cid"]), "members")
    sure = _matrix.compare_inside(sets.filter("family is not null").select("cid", "n", "key", "members", F.col("family").alias("grp")), num, den)
    known = sure.unionByName(node_edges(rows, classes))
    left = sets.filter("rest").drop("family", "rest")
    found = _matrix.link_components(staged(left, "rest"), num, den, known=known)
    result = components_of(rows, classes, found)
    return result.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLE = f"""
WITH RECURSIVE
words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {SIZE} THEN [array_to_string(w[i:i + {SIZE} - 1], ' ') FOR i IN range(1, len(w) - {SIZE} + 2)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE {DEN} * common.n >= {NUM} * (x.n + y.n - common.n)),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other),
found AS (SELECT reached.doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY reached.doc_id)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM found
"""
