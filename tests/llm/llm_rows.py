"""Rows and fixtures that the tests of this folder share."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def document(doc_id, text, lang="en", source="s"):
    return (doc_id, text, lang, source, None if text is None else len(text))


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Words of a made-up vocabulary, joined to sentences and lines; the same for the same seed."""
    draw = random.Random(seed)
    names = ["".join(random.Random(i).choices("abcdefghijklmnop", k=3 + i % 6)) for i in range(vocabulary)]
    common = ["the", "of", "and", "to", "is"]
    out = [draw.choice(common) if draw.random() < 0.3 else draw.choice(names) for _ in range(words)]
    return " ".join(w + (".\n" if i % 17 == 16 else "") for i, w in enumerate(out)).replace("\n ", "\n")


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, white space, other scripts, ties and repeated rows."""
    base = prose(1, 200)
    return [
        document(0, base), document(1, base), document(1, base), document(2, base + " extra words here"),
        document(3, None, None, None), document(4, ""), document(5, " \t\n "), document(6, "one"), document(7, "é ñ ü 日本 😀"),
        document(8, prose(2, 30_000)), document(None, "no id at all"), document(9, "a  b   c \n\n d \x00 ▁ x"), document(10, prose(3, 80), "fr", "t"),
        (11, prose(4, 60), None, "t", None), document(12, "x" * 5_000),
    ]


@pytest.fixture(scope="session")
def edges(spark, edge_rows, tmp_path_factory):
    """The edge rows with a further column that clashes with columns the operators add."""
    from pyspark.sql import functions as F

    path = str(tmp_path_factory.mktemp("edges"))
    frame = spark.createDataFrame(edge_rows, DOCS)
    frame.withColumns({"score": F.lit("mine"), "ids": F.lit(1), "spans": F.lit(2), "train": F.lit(True)}).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
