"""Operator 5, language ID by rank-order profiles.

Method: a profile lists the most frequent character n-grams (one to three
characters of lower-cased words, with word ends) in order.  A language's
profile is that of all its learning texts together; a text's own is compared
with each by the out-of-place distance, the sum over the text's n-grams of how
far their places differ, an n-gram that the language's profile lacks counting
as ``PLACES``.  The nearest language is the prediction.

Learning counts n-grams over all learning rows; a task merges its counts before
they are shuffled, and what reaches the driver is the profiles, ``PLACES`` rows
a language.  Prediction is a projection of the text.

Rejection (``in_learned_language``) compares a text's closeness with a bound of
its predicted language and text-length band, taken from all learning rows of
that language and band: ``SLACK`` times the ``LOW`` quantile of their closeness
to their own language.  Spark counts closeness in steps of ``1 / STEPS``, so at
most that many rows a language and band reach the driver.  Bands short of
``ENOUGH`` rows take in their neighbours.  What stays undecided: texts of a few
words, whose closeness varies as much as noise does.

Defined cases: null text or text without a letter is ``und`` with score 0; so is
every text where nothing was learned; equal distances go to the first language
by name; repeated rows each get a row; further columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from revscope.llm._common import numbered, pick, ship

#: n-grams in a language's profile, and at most in a text's.
PLACES = 400
UNKNOWN = "und"
#: A text whose closeness to every profile is below this is in none of the languages, whatever was learned.
LEAST = 0.1
#: The quantile of closeness of a language's and band's learning rows, what share of it is the bound, rows
#: from which the quantile counts (the smallest closeness below that), and steps of closeness.
LOW, SLACK, ENOUGH, STEPS = 0.05, 0.6, 100, 1000
_END = np.uint64(1)  # a word's end in an n-gram; letters are above, 0 is no character


def _letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, runs of others as one word end, framed by ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    kinds, which = np.unique(codes, return_inverse=True)
    alpha = np.array([chr(c).isalpha() for c in kinds.tolist()], bool)
    out = np.where(alpha, kinds, 1)[which] if len(kinds) else codes
    out = np.concatenate([[1], out, [1]]).astype(np.uint64)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != _END) | (out[:-1] != _END)
    return out[keep]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct n-grams as numbers, and how often each occurs."""
    c = _letters(text)
    if len(c) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    a, b = c << np.uint64(42), c << np.uint64(21)
    pairs = a[:-1] | b[1:]
    triples = (a[:-2] | b[1:-1] | c[2:])[c[1:-1] != _END]
    return np.unique(np.concatenate([a[c != _END], pairs, triples]), return_counts=True)


def profile(keys: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """The ``places`` most frequent n-grams, ties by number."""
    if len(keys) > places:
        least = np.partition(counts, len(counts) - places)[len(counts) - places]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:places]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, which = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, which, np.concatenate([n for _, n in parts]))
        return keys, counts

    def out() -> Iterator[pa.RecordBatch]:
        for lang, (keys, counts) in held.items():
            yield pa.record_batch({"lang": pa.array([lang] * len(keys)), "ngram": pa.array(keys.view(np.int64)), "n": pa.array(counts)})
        held.clear()

    from revscope.llm._segments import lean, trim

    lean()
    for batch in batches:
        texts: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            parts = texts.setdefault(lang, [])
            parts.append(ngrams(text))
            if len(parts) == 256:
                texts[lang] = [merged(parts)]
        for lang, parts in texts.items():
            held[lang] = merged([*parts, *([held[lang]] if lang in held else [])])
        if sum(len(k) for k, _ in held.values()) > 1_000_000:
            yield from out()
    yield from out()
    trim()


def _learning(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(text, lang) of the rows where ``learn`` (of doc_id if there is one, text, lang) holds."""
    known = {id_col.lower()} & {c.lower() for c in docs.columns}
    rows = pick(docs, text=text_col, lang=lang_col, **({"doc_id": id_col} if known else {}))
    return rows.filter(learn).filter("text is not null and lang is not null").select("text", "lang")


def learned(docs: DataFrame, learn: Column, places: int = PLACES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, ngram, place): profiles of the languages in the rows where ``learn`` (of doc_id, text, lang) holds."""
    ship(docs.sparkSession)
    rows = _learning(docs, learn, id_col, text_col, lang_col)
    counts = rows.mapInArrow(_counted, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "ngram"))
    # the bare row number in the filter lets each task cut its n-grams to ``places`` before the shuffle
    return counts.withColumn("place", place).filter(F.col("place") <= places).select("lang", "ngram", (F.col("place") - 1).alias("place"))


class Profiles:
    """Places of each n-gram in each language's profile."""

    def __init__(self, langs: list[str], rows: list[tuple[str, int, int]], places: int):
        self.langs, self.places = langs, places
        self.keys = np.unique(np.array([k for _, k, _ in rows], np.int64).view(np.uint64))
        self.table = np.full((len(self.keys) + 1, len(langs)), places, np.int64)
        for lang, k, p in rows:
            self.table[np.searchsorted(self.keys, np.array([k], np.int64).view(np.uint64))[0], langs.index(lang)] = p
        self.lacking = len(self.keys)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, closeness to its profile from 0 to 1, lead over the next language)."""
        own = profile(*ngrams(text or ""), self.places)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0, 0.0
        at = np.minimum(np.searchsorted(self.keys, own), self.lacking - 1)
        found = self.table[np.where(self.keys[at] == own, at, self.lacking)]
        mine = np.arange(len(own))[:, None]
        apart = np.where(found == self.places, self.places, np.abs(found - mine)).sum(axis=0) / (self.places * len(own))
        best = int(apart.argmin())
        others = np.delete(apart, best)
        return self.langs[best], float(1 - apart[best]), float(others.min() - apart[best]) if len(others) else 0.0


def load_profiles(profiles: DataFrame, places: int = PLACES) -> Profiles:
    rows = [(r.lang, r.ngram, r.place) for r in profiles.collect()]  # ``places`` rows a language
    return Profiles(sorted({r[0] for r in rows}), rows, places)


def predicted(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """``docs`` with its columns numbered (``__c0``, ...) and lang_pred, score, margin."""
    ship(docs.sparkSession)
    flat, _ = numbered(docs)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import lean, trim

        lean()
        for batch in batches:
            found = [profiles.predict(x.as_py()) for x in batch.column(place)]
            lang, score, margin = (list(x) for x in zip(*found)) if found else ([], [], [])
            more = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "score", "margin"])
        trim()

    schema = StructType(list(flat.schema.fields)).add("lang_pred", "string").add("score", "double").add("margin", "double")
    return flat.mapInArrow(run, schema)


def language_id(docs: DataFrame, learn: Column, held_out: Column, places: int = PLACES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.  ``learn`` and ``held_out`` are of doc_id, text and lang."""
    profiles = load_profiles(learned(docs, learn, places, id_col, text_col, lang_col), places)
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col).select("doc_id", held_out.alias("held_out"), "text")
    return predicted(rows, profiles).select(
        F.col("__c0").cast("long").alias("doc_id"), F.col("__c1").alias("held_out"), "lang_pred", "score", "margin"
    )


def _band(text: Column) -> Column:
    """The text-length band: lengths up to twice the least one."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def rejection_bounds(rows: DataFrame, profiles: Profiles) -> dict[tuple[str, int], float]:
    """Bounds by language and band, from learning rows (text, lang); bands between and beside those seen have one too."""
    found = predicted(rows, profiles).filter("__c1 = lang_pred")
    step = F.floor(F.col("score") * STEPS).cast("int")
    counted = found.groupBy(F.col("lang_pred").alias("lang"), _band(F.col("__c0")).alias("band"), step.alias("step")).count()
    held: dict[str, dict[int, dict[int, int]]] = {}
    for r in counted.collect():  # at most STEPS rows a language and band
        held.setdefault(r["lang"], {}).setdefault(r["band"], {})[r["step"]] = r["count"]
    return {(lang, band): _bound(bands, band) for lang, bands in held.items() for band in range(32)}


def _bound(bands: dict[int, dict[int, int]], band: int) -> float:
    steps: dict[int, int] = {}
    for far in range(32):
        for near in {band - far, band + far}:
            for step, n in bands.get(near, {}).items():
                steps[step] = steps.get(step, 0) + n
        if sum(steps.values()) >= ENOUGH:
            break
    total = sum(steps.values())
    left = int(LOW * total) if total >= ENOUGH else 0
    for step in sorted(steps):
        left -= steps[step]
        if left < 0:
            return SLACK * step / STEPS
    return 0.0


def in_learned_language(docs: DataFrame, learn: Column, least: float = LEAST, places: int = PLACES, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in one of the learned languages, all columns."""
    profiles = load_profiles(learned(docs, learn, places, id_col, text_col, lang_col), places)
    rows = _learning(docs, learn, id_col, text_col, lang_col)
    bounds: dict[str, list[float]] = {}
    for (lang, _), bound in sorted(rejection_bounds(rows, profiles).items()):
        bounds.setdefault(lang, []).append(max(bound, least))
    own = predicted(docs, profiles, text_col)
    text = F.col(f"__c{docs.columns.index(text_col)}")
    table = F.lit(None).cast("map<string,array<double>>")
    if bounds:
        table = F.create_map(*[x for lang, row in bounds.items() for x in (F.lit(lang), F.array(*map(F.lit, row)))])
    bound = F.coalesce(F.get(table[F.col("lang_pred")], _band(text)), F.lit(least))
    kept = own.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= bound))
    return kept.drop("lang_pred", "score", "margin").toDF(*docs.columns)
