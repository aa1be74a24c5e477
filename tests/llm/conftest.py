from __future__ import annotations

import random

import pytest
from odd_texts import words
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = [
    "fp", "hash", "h1", "bucket", "score", "text_hash", "block", "slot", "position", "place0", "key",
    "item", "item_id", "root", "component_id", "start", "spans", "kept", "y", "a", "b", "n", "count",
    "_source", "_rank", "_id", "_bad_id", "ahead", "path", "ids", "packed", "own", "label",
]


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, copies, near copies, repeated rows and ids."""
    rng = random.Random(7)
    base, other = words(rng, 120), words(rng, 300)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "de", None),
        (4, None, "en", "b"), (5, "", None, "b"), (6, " \n\t ", "de", "b"), (7, "one", "en", "c"),
        (8, "Ünï ñ 12 !!", None, None), (None, base, "en", "a"), (None, other, None, "c"),
        (None, None, None, None), (9, other * 40, "de", "a"), (10, other + " " + base, "de", "a"),
        (10, "same id other text here", "en", "d"), (11, "Er " * 3000, "en", "d"), (-3, "neg ative", "de", "d"),
    ]
    rows += [(100 + i, words(rng, 60), "en", "a") for i in range(20)]
    return [(*r, len(r[1]) if r[1] else None) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    return docs.select("*", *[F.lit(f"extra {c}").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
