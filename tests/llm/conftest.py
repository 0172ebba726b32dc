from __future__ import annotations

from pathlib import Path

import pytest

SMALL = "/root/testdata/sf0.001"
#: Columns whose names clash with those the operators add.
EXTRA = "score double, n string, kept string, hits int, votes int, digest string, band int, size int"
EXTRA += ", component string, base int, added int, sizes int, n_words int, learn int, label int, row int"


def extra_values():
    return (0.5, "n", "k", 1, 2, "d", 3, 4, "c", 5, 6, 7, 8, 9, 10, 11)


LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(9000))
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick brown fox jumps over the lazy dog again and again"),
    (2, "the quick brown fox jumps over the lazy dog again and again"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one"),
    (7, LONG),
    (None, "no id here, mail a.b@example.com"),
    (None, None),
    (8, "naïve ▁ 　 café\x85x  two  blanks 漢字 😀 \x00"),
    (9, "write to a.b@example.com or +1 (988) 555-2485 from 10.0.0.1"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, empty and long texts, repeated rows, columns with clashing names."""
    rows = [(*row, *extra_values()) for row in TEXTS]
    return spark.createDataFrame(rows, f"doc_id bigint, text string, {EXTRA}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, {EXTRA}")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (None, 1, 1), (2, None, None), (6, 7, 9), (404, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
