from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = "/root/testdata/sf0.001"

# Nulls, empty texts, white space, long texts and words, repeated rows, equal ids, copies, clashing columns.
ODD = [
    (1, None, "en", "s"), (2, "", "en", "s"), (3, " \t\n\x0b\x0c\r", None, "s"), (4, "word", "en", None),
    (5, "Same Text here\n", "en", "s"), (6, "Same\tText here", "en", "s"), (7, "same text here", "de", "s"),
    (8, "x" * 300_000, "en", "s"), (9, "a b c d e f g h i j k l m n o p " * 4_000, "en", "s"),
    (10, "twice the same row", "en", "s"), (10, "twice the same row", "en", "s"),
    (11, "same id, other text", "fr", "s"), (11, "same id, another text", "fr", "s"),
    (None, "row without id", "en", "s"), (None, "row without id", "en", "s"), (None, None, None, None),
    (12, "Zeile\nzwei <|endoftext|> drei\n\nZeile   \U0001f642\U0001f642 mail a.b@c.de\n", "de", "s"),
    (13, "\0null\0 bytes\x7f", "en", "s"), (14, "1" * 50 + " 4012 8888 8888 1881 +1 (555) 010-99.99", "en", "s"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with columns whose names operators use for themselves."""
    frame = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string")
    for name in ("row", "hash", "key_text", "sid", "n", "token", "kept", "score", "dropped", "label"):
        frame = frame.selectExpr("*", f"'clash' AS {name}")
    return frame


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SMALL}/benchmark.parquet")


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(str(v) for v in r))
