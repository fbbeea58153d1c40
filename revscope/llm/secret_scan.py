"""Operator 3, secret scans (DataFrame functions only).

Base spans: assignments, access keys and long hexadecimal runs, found by fixed
patterns.  Method: in candidate strings a window of ``WINDOW`` characters
slides by one; counts of the characters in it are updated by the one that
enters and the one that leaves, and the Shannon entropy with them.  A candidate
is judged by its maximal runs per character class (``RUNS``, itself among them),
so a key counts by its own class whatever touches it: where the highest entropy
of a run reaches its class's threshold, the whole candidate (with the name, path
or padding joined to it) adds a span of kind ``entropy``, unless base spans
cover it.  The allow list silences runs: ``ALLOWED`` has to match a run from
end to end, and what ``CUT`` matches is taken out before runs are made.

Positions are code points, ends exclusive.  Everything is a projection of the
text, so nothing is shuffled.

Defined cases: null text counts as empty and has no spans; very long texts are
scanned whole, a text being split once however many matches it has; repeated rows
each get their own; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import numbered, pick

# the contract's patterns (fixed values)
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6  # characters of an assignment's value; shorter matches are dropped after matching
# 20 and 24 characters at least: runs are maximal, so the length can stand in the pattern
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Runs of the widest class; those with a letter and a digit are candidates.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: A part of a path or name that is a plain word: letters only, of one case but for the first.
_PLAIN = r"(?<![0-9A-Za-z])(?:[A-Za-z]?[a-z]{3,}|[A-Z]{4,})(?![0-9A-Za-z])"
#: Character class of a run (the first that matches it), its pattern, and the entropy in bits from which a
#: window counts: what all but about 1 % of 20 random characters of the class reach.  Paths and names reach
#: that of the last two classes, so joined parts count in full only without a plain word among them.
CLASSES = (
    ("hex", r"^[0-9A-Fa-f]+$", 2.9),
    ("base32", r"^(?:[0-9A-Z]+|[0-9a-z]+)$", 3.3),
    ("alnum", r"^[0-9A-Za-z]+$", 3.64),
    ("base64", rf"^(?!.*{_PLAIN})(?:[0-9A-Za-z+/=]+|[0-9A-Za-z_=-]+)$", 3.64),
    ("joined", r"^", 3.9),
)
#: The runs by which a candidate is judged.
RUNS = tuple(f"[{c}]{{{WINDOW},}}" for c in ("0-9A-Fa-f", "0-9A-Z", "0-9a-z", "0-9A-Za-z", "0-9A-Za-z+/=", "0-9A-Za-z_=-", "0-9A-Za-z+/_=-"))
#: Keys written in dashed groups of one length (4 to 8) and one case; judged without the dashes.
GROUPS = "|".join(
    rf"(?<![0-9A-Za-z])[{c}]{{{n}}}(?:-[{c}]{{{n}}}){{{-(-WINDOW // n) - 1},}}(?![0-9A-Za-z])" for n in range(4, 9) for c in ("0-9A-Z", "0-9a-z")
)
_ROWS = "0123456789|123456789|abcdefghij|qwertyuiop|example|sample|placeholder|dummy|xxxx"
_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
#: Runs that are no secrets, from end to end: letters and digits around a counting or alphabet row or a
#: placeholder word, one unit repeated, UUIDs, file and version names.
ALLOWED = (
    rf"(?i)^[0-9a-z]*(?:{_ROWS})[0-9a-z]*$",
    r"^(.{1,8}?)\1{2,}$",
    rf"(?i)^{_UUID}$",
    r"^[A-Za-z]++(?:[-_/][A-Za-z]++)*+[-_/]?[0-9]{1,4}$",  # possessive: Java recurses for each part otherwise
)
#: What is taken out of a candidate: the first and third of these as parts of it, and the key of public manuals.
CUT = "|".join((
    rf"(?i:(?<![0-9a-z])(?=[0-9a-z]*?(?:{_ROWS}))[0-9a-z]+)",
    rf"(?i:(?<![0-9a-z]){_UUID}(?![0-9a-z]))",
    "wJalrXUtnFEMI/K7MDENG/bPxRfiCY[0-9A-Za-z]*",
))

def spans(text: Column, matches: Column, pattern: str) -> Column:
    """(start, end) of all ``matches`` of ``pattern``: the gaps between them tell where they lie.

    As arrays' only elements the gaps and the matches are variables, made once a
    text and not at every match."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda g: F.length(g)).alias("gap"), F.transform(matches, lambda m: F.length(m)).alias("match")
    )

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + x["gap"]
        end = begin + x["match"]
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(F.struct(begin.alias("start"), end.alias("end")))).alias("out"))

    # there is one gap more than matches: the text's rest
    found = lambda zipped: F.aggregate(F.slice(zipped, 1, F.size(zipped) - 1), start, step, lambda s: s["out"])
    return F.when(F.size(matches) > 0, F.get(F.transform(F.array(lengths), found), F.lit(0))).otherwise(empty)


def highest_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy (bits) of a window of ``value``, by incremental counts."""
    # as an array's only element the codes are a variable, made once and not at every step
    once = F.array(F.transform(F.split(value, ""), lambda c: F.ascii(c)))
    return F.get(F.transform(once, lambda codes: _highest(codes, window)), F.lit(0))


def _highest(codes: Column, window: int) -> Column:
    weight = lambda n: F.when(n > 0, n * F.log2(n)).otherwise(F.lit(0.0))
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def step(s: Column, i: Column) -> Column:
        enters, leaves = F.get(codes, i), F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
        grown, shrunk = F.get(s["counts"], enters), F.get(s["counts"], leaves)
        change = F.when(enters == leaves, F.lit(0.0)).otherwise(
            weight(grown + 1) - weight(grown) + F.when(leaves >= 0, weight(shrunk - 1) - weight(shrunk)).otherwise(F.lit(0.0))
        )
        counts = F.transform(s["counts"], lambda n, k: n + (k == enters).cast("int") - (k == leaves).cast("int"))
        total = s["sum"] + change
        entropy = F.log2(F.lit(float(window))) - total / window
        best = F.when((i >= window - 1) & (entropy > s["best"]), entropy).otherwise(s["best"])
        return F.struct(counts.alias("counts"), total.alias("sum"), best.alias("best"))

    return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, step, lambda s: s["best"])


def _suspicious(value: Column, window: int) -> Column:
    threshold = F.lit(None).cast("double")
    for _, pattern, bits in reversed(CLASSES):
        threshold = F.when(value.rlike(pattern), F.lit(bits)).otherwise(threshold)
    # the sum of changes may end a rounding error below the threshold
    return _mixed(value) & ~_allowed(value) & (highest_entropy(value, window) >= threshold - 1e-9)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _allowed(value: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | value.rlike(pattern)
    return allowed


def _judged(candidate: Column, window: int) -> Column:
    """Whether a run of ``candidate`` is suspicious."""
    rest = F.regexp_replace(candidate, CUT, " ")
    groups = F.transform(F.regexp_extract_all(rest, F.lit(GROUPS), 0), lambda v: F.replace(v, F.lit("-"), F.lit("")))
    runs = F.array_distinct(F.concat(*[F.regexp_extract_all(rest, F.lit(pattern), 0) for pattern in RUNS], groups))
    return F.when(_mixed(candidate) & ~_allowed(candidate), F.exists(runs, lambda v: _suspicious(v, window))).otherwise(F.lit(False))


def _kind(places: Column, kind: int, keep: Column | None = None) -> Column:
    """(start, kind, end) of ``places``; ``keep``: a flag for each."""
    rows = F.transform(places, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))
    if keep is None:
        return rows
    paired = F.arrays_zip(rows.alias("row"), keep.alias("ok"))
    return F.transform(F.filter(paired, lambda x: x["ok"]), lambda x: x["row"])


def scanned(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """``rows`` (row, text) with base and spans: arrays of (start, kind, end), kind an index of ``KINDS``."""
    matched = rows.select(
        "row",
        F.coalesce("text", F.lit("")).alias("text"),
    ).select(
        "*",
        F.regexp_extract_all("text", F.lit(ASSIGN), 0).alias("m_assign"),
        F.regexp_extract_all("text", F.lit(ACCESS), 0).alias("m_access"),
        F.regexp_extract_all("text", F.lit(HEX), 0).alias("m_hex"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("m_candidate"),
    )
    values = F.regexp_extract_all("text", F.lit(ASSIGN), 2)
    long = F.transform(values, lambda v: F.length(v) >= ASSIGN_LEAST)
    text = F.col("text")
    base = F.when(
        F.size("m_assign") + F.size("m_access") + F.size("m_hex") > 0,
        F.array_sort(
            F.concat(
                _kind(spans(text, F.col("m_assign"), ASSIGN), 0, long),
                _kind(spans(text, F.col("m_access"), ACCESS), 1),
                _kind(spans(text, F.col("m_hex"), HEX), 2),
            )
        ),
    ).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    based = matched.select("row", "text", "m_candidate", base.alias("base"))
    judged = F.transform("m_candidate", lambda v: _judged(v, window))
    added = F.when(
        F.size("m_candidate") > 0,
        F.filter(
            _kind(spans(text, F.col("m_candidate"), CANDIDATE), 3, judged),
            lambda x: ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])),
        ),
    ).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))
    return based.select("row", "text", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined(places: Column | str) -> Column:
    """kind:start:end of each place, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(places, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"], x["end"])), ",")


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans."""
    rows = scanned(pick(docs, row=id_col, text=text_col))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return rows.select(
        F.col("row").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def redacted(text: Column, places: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each place (sorted by start) replaced by ``mark``; overlapping ones as one."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        gap = F.substring(text, s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0)))
        fresh = F.concat(s["out"], F.array(gap, F.lit(mark)))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(x["start"] >= s["at"], fresh).otherwise(s["out"]).alias("out"))

    rest = lambda s: F.concat(F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text)))
    return F.when(F.size(places) > 0, F.aggregate(places, start, step, rest)).otherwise(text)


def without_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the found secrets of its text replaced, all rows and columns; null text stays null."""
    flat, names = numbered(docs)
    own = names[docs.columns.index(text_col)]
    rows = scanned(flat.select(F.struct("*").alias("row"), F.col(own).alias("text")))
    clean = F.when(F.col(f"row.{own}").isNotNull(), redacted(F.col("text"), F.col("spans")))
    return rows.select(*[(clean if n == own else F.col(f"row.{n}")).alias(n) for n in names]).toDF(*docs.columns)
