"""Conversation repair against a search over all edits and a plain reading of the contract."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from revscope.llm import conversation_repair as cr

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, [(role, text)]) by best-first search over (cost, audit): rows are (role, text, must go, truncated)."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, last, out = heapq.heappop(heap)
        if (at, last) in done:
            continue
        done.add((at, last))
        if at == len(rows) and last in ("", "a"):
            return cost, audit, list(out)
        if at < len(rows):
            role, text, gone, cut = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, out))
            if not gone:
                for new, extra, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if (last, new[:1]) in STEP:
                        heapq.heappush(heap, (cost + extra + cut, audit + letter, at + 1, STEP[last, new[:1]], (*out, (new, text))))
        for new in ("user", "assistant"):
            if (last, new[0]) in STEP:
                heapq.heappush(heap, (cost + 2, audit + "I", at, new[0], (*out, (new, ""))))


def brute(table):
    """The contract read row by row; ``table``: (conv_id, turn, role, text)."""
    convs = {}
    for c, t, role, text in table:
        rows = convs.setdefault(c, [])
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        if kind:
            rows += [(t, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults, judged = set(), [0, 0, 0], []
        for _, role, text in rows:
            left = text.rstrip(SPACE)
            fault = 0 if not left else 1 if (role, text) in seen else 2 if left[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            judged.append((role, text, fault in (0, 1), int(fault == 2)))
        initials = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, fixed = cheapest(judged)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        out[c] = (gaps, *faults, illegal, cost, audit, digest)
    return out


def got(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_every_short_sequence_by_search():
    grammar = cr.Grammar()
    symbols = [(i, f) for i in range(4) for f in (0, 2)] + [(0, 1)]
    sequences = [s for n in range(5) for s in itertools.product(symbols, repeat=n)]
    random.Random(1).shuffle(sequences)
    sequences = sequences[:2500]
    names = ["system", "user", "assistant", "tool"]
    found = grammar.repaired([np.array([3 * i + f if f != 1 else 1 for i, f in s], np.int64) for s in sequences])
    for s, answer in zip(sequences, found):
        want = cheapest([(names[i], "", f == 1, int(f == 2)) for i, f in s])
        assert answer == want[:2], s
    assert len(grammar.rules) > 50


def test_long_sequences_by_search():
    r = random.Random(2)
    sequences = [[r.choice([(0, 0), (1, 0), (2, 0), (1, 0), (2, 0), (1, 2), (2, 2), (3, 0), (0, 1)]) for _ in range(r.randint(20, 300))] for _ in range(40)]
    sequences += [[(1, 0)] * 99, [(1, 0), (2, 0)] * 200]
    names = ["system", "user", "assistant", "tool"]
    found = cr.Grammar().repaired([np.array([3 * i + f if f != 1 else 1 for i, f in s], np.int64) for s in sequences])
    for s, answer in zip(sequences, found):
        assert answer == cheapest([(names[i], "", f == 1, int(f == 2)) for i, f in s])[:2]


def rows_of(seed):
    r = random.Random(seed)
    texts = ["Hello there.", "Why?", "no end", "", " \t", "a.b!c?", "Yes!\n ", "Ünï. ", None, "x" * 5000 + "."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "User", ""]
    rows = []
    for c in range(120):
        turns = sorted(r.sample(range(-3, 14), r.randint(0, 9)))
        rows += [(c, t, r.choice(roles), r.choice(texts)) for t in turns]
    rows += [(500, None, "user", "a."), (500, None, "system", "s."), (500, 3, "user", "b."), (500, 3, "user", "b."), (None, 1, "user", "q?"), (None, 2, "assistant", "w.")]
    rows += [(600 + k, 0, "user", "only.") for k in range(300)]  # some lose their only row
    r.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("parts,batch", [(1, 1 << 20), (6, 5)])
def test_equals_the_contract(spark, monkeypatch, parts, batch):
    monkeypatch.setattr(cr, "BATCH_SYMBOLS", batch)
    rows = rows_of(parts)
    want = brute(rows)
    assert any(w[-2] == "" for w in want.values())
    assert got(cr.repair(spark.createDataFrame(rows, SCHEMA).repartition(parts))) == want


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert got(cr.repair(table)) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_clashing_names_and_empty_table(spark):
    rows = rows_of(9)[:50]
    wide = spark.createDataFrame([(*r, "x", True, "a", 7) for r in rows], SCHEMA + ", Text string, first boolean, audit string, copy int")
    assert got(cr.repair(wide)) == brute(rows)
    assert cr.repair(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ropes_compare_as_texts():
    r = random.Random(5)
    for _ in range(300):
        words = ["".join(r.choice("DIKR") for _ in range(r.randint(0, 6))) for _ in range(2)]
        ropes = []
        for w in words:
            k = r.randint(0, len(w))
            ropes.append(cr.joined(cr.Rope(w[:k]), cr.joined(cr.Rope(w[k : k + 1]), cr.Rope(w[k + 1 :]))))
        assert [x.text() for x in ropes] == words and cr.less(*ropes) == (words[0] < words[1])
