from __future__ import annotations

import pytest

#: Columns whose names the operators use themselves.
CLASHING = ["doc", "id", "tokens", "node", "score", "hash", "text_key", "_text", "x1", "seed"]


@pytest.fixture(scope="session")
def sentence():
    return "Ein Satz, der aus einigen Wörtern besteht, steht hier und noch einmal anders da. "


@pytest.fixture(scope="session")
def odd_documents(spark, sentence):
    """NULL, empty, blank, short, long, repeated rows, NULL keys and clashing columns."""
    long_text = " ".join(f"wort{i % 9973}x{i}" for i in range(30_000))
    rows = [
        (1, None, "de", "a"),
        (2, "", None, None),
        (3, " \t\n ", "de", "a"),
        (4, "kurz", "de", "a"),
        (5, long_text, "de", "a"),
        (6, sentence * 12, "de", "a"),
        (7, sentence * 12, None, "a"),
        (8, "aaaa " * 400, "de", None),
        (9, "x" * 5_000, "de", "a"),
        (10, "é" * 300 + "\x00  \U0001f600" * 90, "de", "a"),
        (10, "é" * 300 + "\x00  \U0001f600" * 90, "de", "a"),
        (None, "a row without a key " * 30, "de", "a"),
    ]
    schema = "doc_id long, text string, lang string, source string"
    frame = spark.createDataFrame(rows, schema)
    frame = frame.selectExpr("*", "cast(length(text) AS long) AS n_chars")
    return frame.selectExpr("*", *[f"'{c}' AS `{c}`" for c in CLASHING])


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
