"""Exact links among sets by the token-group matrix: ``link_edges``.

Similar sets are partitioned into groups of bounded size.  Inside a group, a
matrix of members by tokens gives all overlaps at once.  Between groups, each
group has the union of its members' tokens: a set's overlap with the union
bounds its overlap with each member, and the group is opened for the set only
where that is enough for a link.  Which sets meet a group's union at all is
found by ids alone, from the union of the members' rarest tokens; a set and a
group's members are then fetched once for each group and block of sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revscope.llm import _shared
from revscope.llm._common import staged
from revscope.llm._segments import trimmed
from revscope.llm._words import components, mix

#: A group holds about so many tokens and sets at most.
GROUP_TOKENS, GROUP_SETS = 500_000, 768
#: Partitions of all sets into groups that are compared inside before groups are compared with each other.
ROUNDS = 2

#: A set: its node, full size, own name, tokens (sorted unsigned 64-bit numbers) that may be in other sets.
SET = "cid long, n long, key long, members binary"
EDGES = "src long, dst long"


def overlaps(sets: list[np.ndarray], queries: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes, members by queries: the matrix of both by tokens, block by block of tokens."""
    sizes = np.array([len(s) for s in sets + queries])
    row = np.repeat(np.arange(len(sizes)), sizes)
    token, which, often = np.unique(np.concatenate([*sets, *queries]), return_inverse=True, return_counts=True)
    shared = often > 1  # a token of one set only is in no intersection
    place = np.cumsum(shared) - 1
    keep = shared[which]
    row, column = row[keep], place[which[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(queries) or len(sets)), np.float32)
    width = max(256, (16 << 20) // max(len(sizes), 1))
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        block = np.zeros((len(sizes), min(width, int(shared.sum()) - low)), np.float32)
        block[row[a:b], column[a:b] - low] = 1
        out += block[: len(sets)] @ (block[len(sets) :] if queries else block).T
    return out


def _linked(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    common = overlap.astype(np.int64)
    return (den * common >= num * (a[:, None] + b[None, :] - common)) & (common > 0)


def _sets(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in table.column("members").to_pylist()]


def _apart(run, by: list[str]):
    """``run`` for each group of a bundle of groups: few large calls in place of many small ones."""

    def each(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in by])
        keys = np.stack([table.column(c).to_numpy() for c in by])
        starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]])).tolist()
        return pa.concat_tables([run(table.slice(a, b - a)) for a, b in zip(starts, starts[1:])])

    return each


def _inside(num: int, den: int):
    """Components inside a group: an edge from each set to its component's smallest node."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("cid", "ascending"), ("key", "ascending")])
        cid, sizes, sets = table.column("cid").to_numpy(), table.column("n").to_numpy(), _sets(table)
        label = np.arange(len(sets))
        if len(sets) > 1:
            link = _linked(overlaps(sets, []), sizes, sizes, num, den)
            while True:
                new = np.where(link, label[None, :], len(sets)).min(axis=1, initial=len(sets))
                new = np.minimum(new, label)
                new = new[new]
                if (new == label).all():
                    break
                label = new
        to = cid[label]
        return pa.table({"src": cid[to != cid], "dst": to[to != cid]})

    return run


def opened(sets: list[np.ndarray], queries: list[np.ndarray], sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """The queries (places) for which a group is opened: those whose overlap with its token union is enough for a link."""
    union = np.unique(np.concatenate(sets))
    at = [np.searchsorted(union, q) for q in queries]
    overlap = np.array([int((union[i[i < len(union)]] == q[i < len(union)]).sum()) for i, q in zip(at, queries)])
    return np.flatnonzero(den * overlap >= num * sizes)


def _between(num: int, den: int):
    """Queries against one group: an edge for each two components that a link joins."""

    def run(table: pa.Table) -> pa.Table:
        owner, sizes, sets = table.column("owner").to_numpy(), table.column("n").to_numpy(), _sets(table)
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        there, query = np.flatnonzero(~asks), np.flatnonzero(asks)
        found = [np.zeros((0, 2), np.int64)]
        if len(there) and len(query):
            query = query[opened([sets[i] for i in there], [sets[i] for i in query], sizes[query], num, den)]
        for low in range(0, len(query) if len(there) else 0, GROUP_SETS):
            q = query[low : low + GROUP_SETS]
            a, b = np.nonzero(_linked(overlaps([sets[i] for i in there], [sets[i] for i in q]), sizes[there], sizes[q], num, den))
            found.append(np.unique(np.stack([owner[there[a]], owner[q[b]]], axis=1), axis=0))
        edges = np.unique(np.concatenate(found), axis=0)
        edges = edges[edges[:, 0] != edges[:, 1]]
        return pa.table({"src": edges[:, 0], "dst": edges[:, 1]})

    return run


def _keyed(salt: int):
    """Adds ``near``, the smallest of a set's tokens in an order of their own: similar sets often agree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [int(mix(np.frombuffer(x, "<u8"), salt).min()) >> 1 if x else 0 for x in batch.column("members").to_pylist()]
            yield batch.append_column("near", pa.array(near, pa.int64()))

    return run


def grouped(sets: DataFrame, salt: int, alone: bool = True) -> DataFrame:
    """``sets`` with ``near`` and ``grp``, of similar sets and of bounded size; without those ``alone`` in a group if so asked."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sets.schema)
    keyed = sets.mapInArrow(_keyed(1000 + salt), f"{schema}, near long")
    tokens = F.octet_length("members") / 8
    sizes = keyed.groupBy("near").agg(F.count("*").alias("__sets"), F.sum(tokens).alias("__tokens"))
    groups = F.greatest(F.ceil(F.col("__sets") / GROUP_SETS), F.ceil(F.col("__tokens") / GROUP_TOKENS), F.lit(1))
    dealt = F.pmod(F.xxhash64("key", F.lit(salt)), groups)
    joined = keyed.join(sizes if alone else sizes.filter("__sets > 1"), "near")
    return joined.withColumn("grp", F.xxhash64("near", dealt)).drop("__sets", "__tokens")


def compare_inside(groups: DataFrame, num: int, den: int, tokens: int | None = None) -> DataFrame:
    """Edges inside the groups ``grp``, bundles of about ``GROUP_TOKENS`` tokens at a time."""
    tokens = _tokens(groups) if tokens is None else tokens
    bundled = groups.withColumn("bundle", F.pmod(F.xxhash64("grp"), F.lit(1 + tokens // GROUP_TOKENS)))
    return staged(bundled.groupBy("bundle").applyInArrow(trimmed(_apart(_inside(num, den), ["grp"])), EDGES), "inside")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x, "<i8") for x in batch.column("members").to_pylist()]
        n = np.array([len(s) for s in sets], np.int64)
        columns = {c: pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in ("key", "owner", "n", "grp")}
        yield pa.record_batch({"token": pa.array(np.concatenate([np.zeros(0, np.int64), *sets])), **columns})


def _compared(left: DataFrame, num: int, den: int) -> list[DataFrame]:
    """Edges for all links among ``left`` (SET and owner) that join two owners."""
    placed = staged(grouped(left, 0), "groups")
    edges = [compare_inside(placed, num, den)]
    cells = placed.select("key", "owner", "n", "grp", "members").mapInArrow(_exploded, "token long, key long, owner long, n long, grp long")
    cells = staged(cells, "cells")
    # a set's rarest tokens: linked sets share one of them, in any common order
    rarity = cells.groupBy("token").agg(F.count("*").alias("often"))
    ranked = cells.join(rarity, "token")
    own, rarest = Window.partitionBy("key"), Window.partitionBy("key").orderBy("often", "token")
    needed = F.ceil(F.lit(num) * F.col("n") / F.lit(den))
    head = F.row_number().over(rarest) <= F.count("*").over(own) - needed + 1
    # groups that hold one of a set's rarest tokens among their members' rarest, and a member of a fitting size
    heads = staged(ranked.select("token", "key", "owner", "n", "grp", head.alias("head")).filter("head").drop("head"), "heads")
    spans = heads.groupBy("token", F.col("grp").alias("to")).agg(*[f("owner").alias(f"{x}_owner") for f, x in ((F.min, "low"), (F.max, "high"))], F.min("n").alias("low_n"), F.max("n").alias("high_n"))
    fits = f"to < grp and not (low_owner = owner and high_owner = owner) and {den} * high_n >= {num} * n and {num} * low_n <= {den} * n"
    near = staged(heads.join(spans, "token").filter(fits).select("key", "to").distinct(), "near")
    # those sets come in blocks of bounded size, each with the group's members
    load = near.groupBy("to").agg(F.ceil(F.count("*") / GROUP_SETS).alias("blocks"))
    asked = near.join(load, "to").withColumn("block", F.pmod(F.xxhash64("key"), "blocks"))
    sets = placed.select("owner", "n", "key", "members")
    queries = asked.join(sets, "key").select("to", "block", "owner", "n", "members", F.lit(True).alias("asks"))
    blocks = load.select("to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    held = placed.join(blocks, placed["grp"] == blocks["to"]).select("to", "block", "owner", "n", "members", F.lit(False).alias("asks"))
    both = staged(queries.unionByName(held), "blocks")
    bundled = both.withColumn("bundle", F.pmod(F.xxhash64("to", "block"), F.lit(1 + _tokens(both) // GROUP_TOKENS)))
    return [*edges, staged(bundled.groupBy("bundle").applyInArrow(trimmed(_apart(_between(num, den), ["to", "block"])), EDGES), "between")]


def _tokens(sets: DataFrame) -> int:
    return int(sets.agg(F.sum(F.octet_length("members"))).first()[0] or 0) // 8


def link_components(sets: DataFrame, num: int, den: int, known: DataFrame | None = None) -> DataFrame:
    """(node, component) for the nodes of ``sets`` (SET, staged) that links of similarity ``num / den`` join to others.

    ``known``: edges (src, dst) found before.  1. Sets are compared inside
    groups of similar ones, ``ROUNDS`` partitions of all sets.  2. What is left
    are links between components: only tokens that two components hold count for
    those, and a set with too few of them has none (``shared_tokens``).  3. The
    sets left are compared by the token-group matrix.
    """
    tokens = _tokens(sets)
    edges = [known] if known is not None else []
    edges += [compare_inside(grouped(sets, salt, alone=False), num, den, tokens) for salt in range(1, ROUNDS + 1)]
    named = components(_union(edges), "src", "dst")
    owned = sets.join(named, sets["cid"] == named["node"], "left").select("cid", "n", "key", F.coalesce("component", "cid").alias("owner"), "members")
    bits = _shared.part_bits(tokens)
    cells = owned.mapInArrow(_shared.members_dealt(bits), _shared.CELLS)
    left = _shared.shared_tokens(cells, bits, num, den, owners=True).filter("members is not null")
    left = staged(left.select(F.col("id").alias("cid"), "n", F.col("k1").alias("key"), F.col("k2").alias("owner"), "members"), "left")
    if not left.limit(1).count():
        return named
    more = _union(_compared(left, num, den))
    return components(named.select(F.col("node").alias("src"), F.col("component").alias("dst")).unionByName(more), "src", "dst")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
