from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]
#: Extra columns with names that operators might use themselves.
EXTRA = "_key long, n long, id string, _row long, _h long, _at string, hash long, component long, value string, place long"


@pytest.fixture(scope="session")
def prose():
    """`prose(n, seed)`: n words that repeat little."""

    def make(n: int, seed: int) -> str:
        rng = random.Random(seed)
        return " ".join(rng.choice(WORDS) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def corpus(prose):
    """`(doc_id, text, lang, source)` rows: copies, near copies, nulls, empty, odd white space, one very long text."""
    base = [prose(120, s) for s in range(8)]
    words = base[0].split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    return [
        *((i, t, "en", "a" if i < 5 else "b") for i, t in enumerate(base)),
        (20, base[0], "en", "a"),
        (21, near, "en", "c"),
        (22, base[0].upper().replace(" ", "\n\t"), "en", None),
        (23, None, None, "a"),
        (24, "", "en", "a"),
        (25, " \n\t ", "en", "b"),
        (26, "one two three", "en", "b"),
        (27, "One  two three", "en", "b"),
        (28, "   日本語 éé <|endoftext|> </s>", "fr", "d"),
        (29, prose(30_000, 99), "en", "a"),
        (30, "x" * 50_000, "en", None),
        (None, base[3], "en", "a"),
        (31, "tie tie tie\ntie tie tie\n\ntie tie tie", None, "d"),
        (31, "tie tie tie\ntie tie tie\n\ntie tie tie", None, "d"),
    ]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    rows = [(*r, *[7, 7, "x", 7, 7, "y", 7, 7, "z", 7]) for r in corpus]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, {EXTRA}").repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(documents):
    return documents.limit(0)
