"""Operator 8, toxicity by a counterfactually regularised classifier.

Method: logistic regression on which words a text has, each word scaled by the
log ratio of its shares in the two labels' texts, the labels weighing alike.  In
each learning text that names a group, the identity term is swapped for the next of its category
and for the neutral one of its language; where the text has that word already, the
term just goes.  The squared change of the logit between the text and
its swap is added to the loss, so a group's name by itself moves the score
little, whatever the labels say of it.  Terms are English, German, Spanish and French.

The classifier is fitted on a bounded sample of the learning rows (at most
``SAMPLE`` of each label, those with the smallest hash of the id), reduced to
word hashes where the texts are, so no text is shuffled; one task fits it.  Its weights
reach the driver and the scoring tasks: one for each word that enough texts of the
sample have, at most ``MOST_WORDS`` (those in most texts; 16 bytes each), besides the
identity terms.  Scoring is a projection of the text.

Defined cases: null text counts as empty and gets the model's score of a text
without words; labels without a text, labels other than 0 and 1 and texts without a label
teach nothing; where no label 1 or no label 0 was learned every score is the
share of label 1 (0 if nothing was); repeated rows each get a row; further
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revscope.llm._common import pick, ship, staged

SAMPLE = 6_000
LEAST_TEXTS, MOST_WORDS = 5, 1 << 20
RIDGE, SWAP_PENALTY, PRIOR = 1e-2, 1.0, 0.5
ROUNDS, RATE = 150, 0.1
SLICE_BYTES = 6 << 20
#: Neutral term of each language, and identity terms by category; a term is swapped within its own category.
IDENTITY = {
    "people": (
        ("women", "men", "girls", "boys", "woman", "man", "trans", "transgender", "nonbinary"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "muslims", "christians", "jews", "hindus", "catholics"),
        ("black", "white", "asian", "latino", "arab", "african", "european", "indigenous", "roma", "blacks", "whites", "asians"),
        ("gay", "lesbian", "bisexual", "straight", "homosexual", "heterosexual", "queer"),
        ("immigrants", "refugees", "foreigners", "migrants", "immigrant", "refugee", "foreigner"),
        ("disabled", "blind", "deaf", "autistic", "old", "elderly", "young", "poor"),
    ),
    "menschen": (
        ("frauen", "männer", "mädchen", "jungen", "frau", "mann", "transfrauen", "transmänner"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten", "katholiken", "muslimisch", "christlich", "jüdisch"),
        ("schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer", "türken", "sinti", "roma"),
        ("schwule", "lesben", "bisexuelle", "homosexuelle", "heterosexuelle", "queere"),
        ("einwanderer", "flüchtlinge", "geflüchtete", "ausländer", "migranten"),
        ("behinderte", "blinde", "gehörlose", "autisten", "alte", "junge"),
    ),
    "personas": (
        ("mujeres", "hombres", "niñas", "niños", "mujer", "hombre", "transexuales"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos", "católicos", "musulmán", "cristiano", "judío"),
        ("negros", "blancos", "asiáticos", "árabes", "africanos", "europeos", "latinos", "indígenas", "gitanos"),
        ("gais", "lesbianas", "bisexuales", "homosexuales", "heterosexuales"),
        ("inmigrantes", "refugiados", "extranjeros", "migrantes"),
        ("discapacitados", "ciegos", "sordos", "autistas", "ancianos", "jóvenes", "pobres"),
    ),
    "personnes": (
        ("femmes", "hommes", "filles", "garçons", "femme", "homme", "transgenres"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées", "catholiques", "musulman", "chrétien", "juif"),
        ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens", "autochtones", "roms"),
        ("gays", "lesbiennes", "bisexuels", "homosexuels", "hétérosexuels"),
        ("immigrés", "réfugiés", "étrangers", "migrants"),
        ("handicapés", "aveugles", "sourds", "autistes", "vieux", "jeunes", "pauvres"),
    ),
}
_WORD = re.compile(r"[^\W\d_]+")


def _hash(word: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word.encode())


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct words of each text, text after text, and offsets."""
    from revscope.llm._segments import ragged
    from revscope.llm._words import split_words

    parts = split_words(texts)
    offsets = parts.offsets.to_numpy()
    offsets = offsets - offsets[0]
    coded = parts.flatten().dictionary_encode()
    found = [[_hash(w) for w in _WORD.findall(x.lower())] for x in coded.dictionary.to_pylist()]
    counts = np.array([len(x) for x in found], np.int64)
    hashes = np.array([h for x in found for h in x], np.uint64)
    index = coded.indices.to_numpy()
    n = counts[index]
    flat = hashes[ragged((np.cumsum(counts) - counts)[index], n)]
    ends = np.concatenate([[0], np.cumsum(n)])[offsets]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
    order = np.lexsort((flat, row))
    row, flat = row[order], flat[order]
    first = np.ones(len(flat), bool)
    first[1:] = (row[1:] != row[:-1]) | (flat[1:] != flat[:-1])
    return flat[first], np.searchsorted(row[first], np.arange(len(offsets)))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from revscope.llm._segments import slices

    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            flat, ends = _words(part.column("text"))
            raw = memoryview(flat).cast("B")
            cells = [bytes(raw[8 * a : 8 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.record_batch({"doc_id": part.column("doc_id"), "toxic": part.column("toxic"), "words": pa.array(cells, pa.binary())})


def _swaps() -> list[tuple[int, int]]:
    """(term, its swap) as word hashes: the next of its category, and its language's neutral one."""
    pairs = {}
    for neutral, categories in IDENTITY.items():
        for terms in categories:
            for k, term in enumerate(terms):
                pairs |= {(_hash(term), _hash(terms[(k + 1) % len(terms)])): None, (_hash(term), _hash(neutral)): None}
    return list(pairs)


def fit(sets: list[np.ndarray], labels: np.ndarray, swaps: list[tuple[int, int]], penalty: float = SWAP_PENALTY) -> tuple[np.ndarray, np.ndarray, float]:
    """(word hashes in order, their weights, bias) of the regularised regression; no ``penalty``, a plain one."""
    sizes = np.array([len(s) for s in sets])
    words, which, often = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    terms = np.array(sorted({h for pair in swaps for h in pair}), np.uint64)
    keep = often >= LEAST_TEXTS
    if keep.sum() > MOST_WORDS:
        keep[:] = False
        keep[np.lexsort((words, -often))[:MOST_WORDS]] = True
    keep |= np.isin(words, terms)
    keys = np.union1d(words[keep], terms)
    row = np.repeat(np.arange(len(sets)), sizes)[keep[which]]
    column = np.searchsorted(keys, words[which[keep[which]]])
    # a swap changes two features, or only its term's where the text has both
    out = np.searchsorted(keys, np.array([a for a, _ in swaps], np.uint64))
    into = np.searchsorted(keys, np.array([b for _, b in swaps], np.uint64))
    having = {k: row[column == k] for k in np.unique(np.concatenate([out, into]))}
    both = np.array([len(np.intersect1d(having[a], having[b], True)) for a, b in zip(out, into)], np.float64) / max(len(sets), 1)
    alone = np.array([len(having[a]) for a in out], np.float64) / max(len(sets), 1) - both
    ones, zeros = labels.sum(), (1 - labels).sum()
    in_ones = (np.bincount(column, weights=labels[row], minlength=len(keys)) + PRIOR) / (ones + 2 * PRIOR)
    in_zeros = (np.bincount(column, weights=1 - labels[row], minlength=len(keys)) + PRIOR) / (zeros + 2 * PRIOR)
    scale = np.log(in_ones / in_zeros)
    share = np.where(labels == 1, 0.5 / ones, 0.5 / zeros)
    w, bias = np.zeros(len(keys)), 0.0
    m, v = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for t in range(1, ROUNDS + 1):
        u = w * scale
        z = np.bincount(row, weights=u[column], minlength=len(sets)) + bias
        error = (1 / (1 + np.exp(-z)) - labels) * share
        change = 2 * penalty * alone * (u[into] - u[out])
        slope = np.bincount(column, weights=error[row], minlength=len(keys))
        np.add.at(slope, into, change)
        np.add.at(slope, out, 2 * penalty * both * u[out] - change)
        slope = np.append(slope * scale + RIDGE * w, error.sum())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        move = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return keys, w * scale, float(bias)


def _fitted(batches: Iterator[pa.RecordBatch], penalty: float) -> Iterator[pa.RecordBatch]:
    sets, labels = [], []
    for batch in batches:
        labels += batch.column("toxic").to_pylist()
        sets += [np.frombuffer(x, np.uint64) for x in batch.column("words").to_pylist()]
    y = np.array(labels, np.float64)
    if not len(y):
        return
    if y.min() == y.max():  # one label only: its share is the score
        keys, w, bias = np.zeros(0, np.uint64), np.zeros(0), np.inf if y[0] else -np.inf
    else:
        keys, w, bias = fit(sets, y, _swaps(), penalty)
    yield pa.record_batch({"word": pa.array(np.append(keys, np.uint64(0)).view(np.int64)), "weight": pa.array(np.append(w, bias)), "bias": pa.array([False] * len(w) + [True])})


class Model:
    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        order = np.argsort(keys)
        self.keys, self.weights, self.bias = keys[order], weights[order], bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        flat, ends = _words(texts)
        weight = np.zeros(len(flat) + 1)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, flat), len(self.keys) - 1)
            weight[:-1] = np.where(self.keys[at] == flat, self.weights[at], 0.0)
        sums = np.concatenate([[0.0], np.cumsum(weight)])
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(sums[ends[1:]] - sums[ends[:-1]] + self.bias)))


def smallest(marked: DataFrame, most: int) -> DataFrame:
    """``most`` rows of each label, those with the smallest hash of the id: a top-k in each task, then of these."""
    order = [F.xxhash64("doc_id"), *[c for c in marked.columns if c != "toxic"]]
    zeros, ones = (marked.filter(F.col("toxic") == v).orderBy(*order).limit(most) for v in (0, 1))
    return zeros.unionAll(ones)


def learned(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE, penalty: float = SWAP_PENALTY, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The classifier fitted on at most ``sample`` rows of each label of those where ``learn`` (of doc_id) holds."""
    ship(docs.sparkSession)
    marked = pick(labels, doc_id=id_col, toxic="toxic").filter("toxic in (0, 1) and doc_id is not null").filter(learn)
    # twice the rows first, so that labels without a document are made up for
    chosen = staged(smallest(marked, 2 * sample).select("doc_id", F.col("toxic").cast("int").alias("toxic")), "labels")
    texts = pick(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")  # at most 4 * sample rows
    # texts become word hashes where they are; what is ranked and moved is those
    words = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_hashed, "doc_id long, toxic int, words binary")
    kept = smallest(staged(words, "sample"), sample).orderBy("toxic", "words").coalesce(1)
    weights = kept.mapInArrow(lambda batches: _fitted(batches, penalty), "word long, weight double, bias boolean")
    table = weights.toPandas()  # at most MOST_WORDS rows, the identity terms and the bias
    if not len(table):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    is_bias = table["bias"].to_numpy(bool)
    return Model(table["word"].to_numpy(np.int64)[~is_bias].view(np.uint64), table["weight"].to_numpy()[~is_bias], float(table["weight"].to_numpy()[is_bias][0]))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of each document."""
    ship(docs.sparkSession)
    narrow = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from revscope.llm._segments import slices

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield pa.record_batch({"doc_id": part.column("doc_id"), "score": pa.array(model.scores(part.column("text")))})

    rows = narrow.mapInArrow(run, "doc_id long, score double")
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
