"""Operator 13, conversation structure repair by a grammar-compressed DP.

The rows of a conversation, in order, become a sequence of symbols (initial of
the role, fault).  The repaired role initials must match ``(s?(ua)+)?``; the
cheapest edits are found: Keep 0, Rerole to user or assistant 2, Delete 3, which
a blank or duplicate row must be, Insert an empty user or assistant turn 2; a
truncated row that stays adds 1.  Of equally cheap edits the audit (their
initials in order) that is least in ASCII is taken.

Method.  The four states of the pattern make a symbol a 4 x 4 transfer matrix
over (cost, audit), multiplied in the min-plus sense, inserts included.  In a
task, Re-Pair replaces the most frequent pairs of adjacent symbols of a batch of
conversations by new symbols, round by round; a rule's matrix is the product of
its two parts' matrices, made once, bottom-up, and kept for all conversations of
the task.  An audit is a rope: a rule's audits refer to those of its parts, and
are compared leaf by leaf.  Products of matrices need no order of evaluation, as
two equally cheap audits of the same rows and end states are never one the
prefix of the other.

Rows are matched to faults by Spark: a duplicate is found by its key
(conversation, role, text digest), the order by a sort inside partitions that a
task streams, one conversation's symbols at a time.  A second streamed pass
meets each row with its conversation's audit and hashes the repaired rows, so
texts are never held together.

Damage (``damaged``): a row whose crc32 of ``conv_id:turn`` mod 20 is 0 goes, 1
loses its text, 2 its ``[.!?]``, 3 comes twice, 4 becomes the user's.

Defined cases: nulls count as one space (in that key, as role and as text); a
null turn comes first and counts for no gap; a null conv_id is a conversation of
its own; rows of equal turn go by role, then text digest (rows given twice are
thus neighbours, the second a duplicate); a conversation without rows after
damage has zeros, an empty audit and the hash of the empty string; very long
texts are hashed whole; a role is known by its first letter, s, u or a, others
(an empty one too) can only be reroled or deleted; further columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revscope.llm._common import pick, ship, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant; the first and the last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
INITIALS = "sua-"
#: A symbol is 3 * initial + fault (0 none, 1 must go, 2 truncated).
SYMBOLS = 12
#: Symbols that Re-Pair works on at a time, rounds, and the least count of a pair.
BATCH_SYMBOLS, ROUNDS, LEAST = 1 << 20, 200, 4


class Rope:
    """A text made of two ropes or a leaf."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right=None):
        self.left, self.right = left, right
        self.size = len(left) if right is None else left.size + right.size

    def leaves(self) -> Iterator[str]:
        stack = [self]
        while stack:
            r = stack.pop()
            if r.right is None:
                if r.left:
                    yield r.left
            else:
                stack += [r.right, r.left]

    def text(self) -> str:
        return "".join(self.leaves())


EMPTY = Rope("")


def less(a: Rope, b: Rope) -> bool:
    """Whether ``a`` is before ``b`` in ASCII, without making either text."""
    if a is b:
        return False
    one, two = a.leaves(), b.leaves()
    x = y = ""
    while True:
        x, y = x or next(one, ""), y or next(two, "")
        if not x or not y:
            return not x and bool(y)
        n = min(len(x), len(y))
        if x[:n] != y[:n]:
            return x[:n] < y[:n]
        x, y = x[n:], y[n:]


#: A transfer matrix: {(from, to): (cost, audit)}.
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def joined(a: Rope, b: Rope) -> Rope:
    return b if not a.size else a if not b.size else Rope(a, b)


def product(a: Matrix, b: Matrix) -> Matrix:
    """Cheapest way through ``a``, then ``b``; of equally cheap ones the least audit."""
    out: Matrix = {}
    for (i, j), (cost, audit) in a.items():
        for k in range(4):
            if (j, k) in b:
                more, rest = b[j, k]
                total, old = cost + more, out.get((i, k))
                if old is None or total <= old[0]:
                    whole = joined(audit, rest)
                    if old is None or total < old[0] or less(whole, old[1]):
                        out[i, k] = (total, whole)
    return out


def _inserts() -> Matrix:
    """Any number of inserts: the pattern's states are reached by three at most."""
    one: Matrix = {(i, j): (INSERT, Rope("I")) for c in "ua" for i, j in STEPS[c].items()}
    out: Matrix = {(i, i): (0, EMPTY) for i in range(4)}
    step = out
    for _ in range(3):
        step = product(step, one)
        for k, v in step.items():
            if k not in out or v[0] < out[k][0]:
                out[k] = v
    return out


INSERTS = _inserts()


def symbol_matrix(symbol: int) -> Matrix:
    """Inserts, then the edit of one row."""
    initial, fault = INITIALS[symbol // 3], symbol % 3
    edits: Matrix = {(i, i): (DELETE, Rope("D")) for i in range(4)}
    extra = TRUNCATED if fault == 2 else 0
    if fault != 1:
        for c, cost, letter in [(c, REROLE, "R") for c in "ua"] + [(initial, KEEP, "K")]:
            for i, j in STEPS.get(c, {}).items():
                if (i, j) not in edits or cost + extra <= edits[i, j][0]:
                    edits[i, j] = (cost + extra, Rope(letter))
    return product(INSERTS, edits)


class Grammar:
    """Symbols and Re-Pair rules with their matrices, shared by all sequences of a task."""

    def __init__(self, most: int = 50_000):
        self.most = most
        self._clear()

    def _clear(self) -> None:
        self.matrices = [symbol_matrix(s) for s in range(SYMBOLS)]
        self.rules: dict[tuple[int, int], int] = {}
        self.known: dict[bytes, tuple[int, str]] = {}

    def rule(self, a: int, b: int) -> int:
        if (a, b) not in self.rules:
            self.rules[a, b] = len(self.matrices)
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        return self.rules[a, b]

    def compressed(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The sequences after Re-Pair over all of them."""
        gap = np.int64(-1)
        flat = np.concatenate([np.append(s.astype(np.int64), gap) for s in sequences])
        for _ in range(ROUNDS):
            real = (flat[:-1] >= 0) & (flat[1:] >= 0)
            pairs, counts = np.unique((flat[:-1] << 32 | flat[1:])[real], return_counts=True)
            if not len(pairs) or counts.max() < LEAST:
                break
            pair = int(pairs[np.argmax(counts)])
            a, b = pair >> 32, pair & 0xFFFFFFFF
            at = np.flatnonzero((flat[:-1] == a) & (flat[1:] == b))
            if a == b:  # of overlapping pairs every second
                first = np.concatenate([[True], np.diff(at) > 1])
                start = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
                at = at[(at - start) % 2 == 0]
            flat[at] = self.rule(a, b)
            flat = np.delete(flat, at + 1)
        ends = np.flatnonzero(flat == gap)
        return [flat[x:y] for x, y in zip(np.concatenate([[0], ends[:-1] + 1]).tolist(), ends.tolist())]

    def repaired(self, sequences: list[np.ndarray]) -> list[tuple[int, str]]:
        """(cost, audit) of each sequence of symbols."""
        if len(self.matrices) + len(self.known) > self.most:
            self._clear()
        names = [s.astype(np.int8).tobytes() for s in sequences]
        new = list({n: s for n, s in zip(names, sequences) if n not in self.known}.items())
        for (name, _), rules in zip(new, self.compressed([s for _, s in new]) if new else []):
            parts = [self.matrices[r] for r in rules.tolist()] or [{(i, i): (0, EMPTY) for i in range(4)}]
            while len(parts) > 1:  # a balanced product keeps ropes shallow
                parts = [product(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            done = product(parts[0], INSERTS)
            best = None
            for end in (START, ASSISTANT):
                if (START, end) in done:
                    cost, audit = done[START, end]
                    if best is None or cost < best[0] or (cost == best[0] and less(audit, best[1])):
                        best = cost, audit
            self.known[name] = best[0], best[1].text()
        return [self.known[n] for n in names]


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) of the rows after damage, for rows (conv_id, turn, role, text)."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20))
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), "copy")


def last_visible(text: Column) -> Column:
    """The last character of ``text`` that is not ASCII white space."""
    return F.right(F.regexp_replace(text, r"[\x20\x09-\x0D]+\z", ""), F.lit(1))


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` without text: each with its place in the order, initial and first fault (0 none, 1 blank, 2 duplicate, 3 truncated)."""
    end = last_visible(F.col("text"))
    narrow = rows.select(
        "conv_id", "turn", "role", "copy", F.sha2("text", 256).alias("digest"),
        F.when(end == "", 1).when(~end.isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
    )
    seen = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first(), "copy")
    again = F.row_number().over(seen) > 1
    full, blank = narrow.filter("fault <> 1"), narrow.filter("fault = 1")
    full = full.withColumn("fault", F.when(again, 2).otherwise(F.col("fault")))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return full.unionByName(blank).withColumn("initial", code)


#: Null turns come first, as nulls do in an ascending order.
ORDER = ["conv_id", "turn", "role", "digest", "copy"]
REPORT = "conv_id long, first boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _runs(batches: Iterator[pa.RecordBatch], key: str, most: int) -> Iterator[pa.Table]:
    """Tables of complete runs of ``key``, about ``most`` rows each, from sorted batches."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            table = pa.Table.from_batches(held).combine_chunks()
            column = table.column(key)
            last = column[-1].as_py()
            at = table.num_rows
            while at and column[at - 1].as_py() == last:
                at -= 1
            if at:
                yield table.slice(0, at)
                held, rows = table.slice(at).to_batches(), table.num_rows - at
            else:
                held = table.to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults, cost and audit of each conversation, from rows sorted by conversation and order."""
    grammar = Grammar()
    legal = np.zeros((4, 4), bool)
    legal[0, 1] = legal[1, 2] = legal[2, 1] = True
    for table in _runs(batches, "conv_id", BATCH_SYMBOLS):
        conv = table.column("conv_id").combine_chunks()
        key, none = np.asarray(conv.fill_null(0)), np.asarray(conv.is_null())
        starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (none[1:] != none[:-1]), [True]]))
        fault, initial = table.column("fault").to_numpy(), table.column("initial").to_numpy()
        turn = table.column("turn").combine_chunks()
        symbol = 3 * initial + np.where((fault == 1) | (fault == 2), 1, np.where(fault == 3, 2, 0))
        symbol = np.where(symbol % 3 == 1, 1, symbol)  # all that must go are one symbol
        bounds = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
        fixed = grammar.repaired([symbol[a:b] for a, b in bounds])
        broken = np.append(~legal[initial[:-1], initial[1:]], False).astype(np.int64)
        rows = []
        for (a, b), (cost, audit) in zip(bounds, fixed):
            at = np.asarray(turn.slice(a, b - a).drop_null())
            gaps = int(at[-1]) - int(at[0]) + 1 - len(np.unique(at)) if len(at) else 0
            counts = np.bincount(fault[a:b], minlength=4)
            rows.append((conv[a].as_py(), True, gaps, int(counts[1]), int(counts[2]), int(counts[3]), int(broken[a : b - 1].sum()), cost, audit))
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _REPORT.types)], schema=_REPORT)


_REPORT = pa.schema([("conv_id", pa.int64()), ("first", pa.bool_()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string())])


class Repairer:
    """Applies a conversation's audit to its rows, one after another, and hashes what comes out."""

    def __init__(self, audit: str):
        self.edits, self.hash, self.before, self.some = iter(audit), hashlib.sha256(), "", False

    def _put(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.some else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.before, self.some = role[:1], True

    def _next(self) -> str:
        return "assistant" if self.before == "u" else "user"

    def row(self, role: str, text: str) -> None:
        for edit in self.edits:
            if edit == "I":
                self._put(self._next(), "")
                continue
            if edit != "D":
                self._put(role if edit == "K" else self._next(), text)
            return

    def done(self) -> str:
        for _ in self.edits:  # only inserts are left
            self._put(self._next(), "")
        return self.hash.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, repaired_sha256): each conversation's audit comes first, its rows follow in order."""
    conv, now = None, None

    def out() -> pa.RecordBatch:
        return pa.record_batch({"conv_id": pa.array([conv], pa.int64()), "repaired_sha256": pa.array([now.done()])})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")]
        for c, audit, role, text in zip(*columns):
            if audit is not None:
                if now is not None:
                    yield out()
                conv, now = c, Repairer(audit)
            else:
                now.row(role, text)
    if now is not None:
        yield out()


def repair(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: faults of its damaged rows, the cheapest repair and the repaired rows' hash."""
    ship(turns.sparkSession)
    given = pick(turns, conv_id=conv, turn=turn, role=role, text=text)
    given = given.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = damaged(given)
    order = judged(rows).repartition("conv_id").sortWithinPartitions(*ORDER)
    report = staged(order.select("conv_id", "turn", "fault", "initial").mapInArrow(_reported, REPORT), "audits")
    parts = rows.select("conv_id", F.lit(False).alias("first"), "turn", "role", F.sha2("text", 256).alias("digest"), "copy", "text", F.lit(None).cast("string").alias("audit"))
    heads = report.select("conv_id", "first", *[F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("copy", "int"), ("text", "string"))], "audit")
    stream = parts.unionByName(heads).repartition("conv_id").sortWithinPartitions("conv_id", F.col("first").desc(), *ORDER[1:])
    hashes = stream.select("conv_id", "audit", "role", "text").mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    every = given.select("conv_id").distinct()
    same = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"])
    found = report.drop("first").join(hashes, same(report, hashes)).drop(hashes["conv_id"])
    found = found.select(F.col("conv_id").alias("__conv"), *[c for c in found.columns if c != "conv_id"])
    joined_ = every.join(found, every["conv_id"].eqNullSafe(found["__conv"]), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256(b"").hexdigest()
    return joined_.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
