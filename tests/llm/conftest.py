"""Small frames that hold the awkward cases, and the reference rows of the test tables."""

from __future__ import annotations

import os

import pytest

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, component_id string, size int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def sentence(start: int, n: int) -> str:
    return " ".join(f"{WORDS[(start + i) % len(WORDS)]}{start * 100 + i}" for i in range(n))


AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \n\t ", "en", None, 4),
    (4, "one", "en", "s", 3),
    (5, sentence(3, 60), "en", "s", None),
    (5, sentence(3, 60), "en", "s", None),  # a repeated row
    (6, sentence(3, 60), "en", "s", 1),  # an equal text
    (7, sentence(3, 58) + " other words", "fr", "s", 1),
    (8, "é" * 30 + " ü ß 日本 😀", None, "s", 1),
    (None, sentence(3, 60), "en", "s", 1),
    (None, None, None, None, None),
    (9, "x " * 200_000, "en", "s", 1),  # very long
    (10, "y" * 300_000, "en", "s", 1),  # one very long word
    (11, sentence(5, 60).upper(), "de", "s", 1),
    (12, "!!! 123 ...", None, "s", 1),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like those the operators make."""
    return spark.createDataFrame([(*r, 0.5, "mine", 7) for r in AWKWARD], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(5, 1, 0), (5, 1, 0), (7, 0, 1), (8, None, None), (None, 1, 1), (11, 1, 0), (99, 0, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def tables(spark):
    if not os.path.isdir(DATA):
        pytest.skip("test tables are not there")
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")


@pytest.fixture(scope="session")
def corpus(tables):
    return [(r.doc_id, r.text or "") for r in tables("documents").select("doc_id", "text").collect()]
