"""Small tables with every odd case, and what the tests share."""

from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i} und{i % 7}" for i in range(30_000))
# Null ids and texts, empty and blank texts, one very long one, a repeated row, and one id with two texts.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 4),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, LONG),
    (6, "same row"),
    (6, "same row"),
    (7, "first text of seven here"),
    (7, "second text of seven there"),
    (None, "a text without an id"),
    (8, "ünï ½ ´` \x01 \\ ### </turn> <|endoftext|> 𝔘 b"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with columns whose names clash with the operators' own."""
    names = ["doc_id", "text", "score", "kept", "node", "root", "band", "words", "n_words", "failures", "row", "training"]
    return spark.createDataFrame(
        [(i, t, 0.5, None, b"x", 1, 2, ["w"], 3, 4, "r", True) for i, t in ROWS],
        "doc_id long, text string, score double, kept boolean, node binary, root long, band long, words array<string>, "
        "n_words long, failures long, row string, training boolean",
    ).select(*names)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def ids_of(df, column="doc_id"):
    return sorted((row[column] for row in df.select(column).collect()), key=lambda x: (x is not None, x))


ALL_IDS = sorted((i for i, _ in ROWS), key=lambda x: (x is not None, x))
