"""Documents that hold the awkward cases, and helpers of the brute-force checks."""

import random

import pytest

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def word(r):
    return "".join(r.choice(LETTERS) for _ in range(r.randint(1, 7)))


def awkward_rows():
    """(doc_id, text): empty, null, tiny, odd white space, copies, near copies, repeated rows, long texts."""
    r = random.Random(7)
    base = [word(r) for _ in range(120)]
    near = list(base)
    near[40] = "changed"
    long = " ".join(word(r) for _ in range(20_000))
    texts = [
        "", None, " ", "one", "two words", "a  b\t\tc\n\nd ", " leading", "trailing  ", "a b c d",
        " ".join(base), " ".join(base), "  ".join(base), " ".join(near), " ".join(base).upper(), long, long + " end",
        "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" and secret=token: abcdefgh", "AKIA" + "Q7" * 8,
        "key xq7Zk2PvR9sLw4TnB8cYd3Mh is new", "Ünïcödé 日本語 😀 <|endoftext|> it's 12 ½²3", "123 456 --- !!!",
    ]
    rows = list(enumerate(texts))
    rows += [(9, " ".join(base)), (None, "no id"), (None, None), (None, " ".join(base))]
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    """The rows as a table with further columns whose names clash."""
    rows = [(i, t, "x", "fr", 1, "y", t) for i, t in awkward_rows()]
    schema = "doc_id long, text string, Text string, lang string, row int, family string, ids string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
