"""Inputs that operators must take without crashing."""

from __future__ import annotations

import pytest

from llm.llm_support import DATA

LONG = "lorem ipsum dolor " * 12_000 + "x" * 40_000

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "the quick  brown fox jumps over the\tlazy dog near the river bank", "en", None),
    (3, "", "en", "b"),
    (4, None, None, "b"),
    (None, "no id here but words all the same", "de", None),
    (None, None, None, None),
    (5, " \n\t ", None, "c"),
    (6, LONG, "fr", "a"),
    (7, "x", "es", ""),
    (8, "ünï▁cödé 漢字 😀 \x00 end", "", "b"),
    (9, "12345 67890 !!! ???", "en", "c"),
]
# Names that operators use inside, or return.
CLASHING = ("id", "node", "key", "part", "size", "copies", "score", "rank", "_id", "_own", "tokens",
            "members", "chunk", "held_out", "spans", "x", "pivot", "start", "_none", "least", "root")


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, -1 if r[1] is None else len(r[1])) for r in ODD]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    for name in CLASHING:
        docs = docs.selectExpr("*", f"'clash' AS `{name}`")
    return docs


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")
