from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, repeated rows, a long text, and columns named like outputs."""
    words = "the cat sat on a mat and the dog of the house was in it "
    rows = [
        (1, words * 8, "en", "quality", 7),
        (2, words * 8, None, None, None),
        (2, words * 8, None, None, None),
        (3, None, "en", "x", 0),
        (4, "", "en", "x", 0),
        (5, " \t\n\x0b ", "en", "x", 0),
        (None, "alone", "fr", "x", 5),
        (6, "word " * 30_000, "en", "x", 1),
        (7, "İstanbul \x01 a\x01b \x1c  c\n\n\nd <|endoftext|> </s>", "de", "x", 1),
        (8, "one", "en", "x", 3),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("quality", "secrets", "toxicity", "kept", "ids", "label", "component_id"):
        frame = frame.selectExpr("*", f"doc_id AS `{name}`")
    return frame


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
