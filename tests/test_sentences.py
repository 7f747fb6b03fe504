from __future__ import annotations

import math
import random
import time
import unicodedata
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from precis.operators import sentences

#: A corpus that shows its abbreviations: they have a full stop nearly always, other words where sentences end.
CORPUS = [
    *["We met Dr. Smith and Mr. Jones today. They said it was fine, e.g. the house and the garden. It was cold."] * 20,
    *["The garden was cold today and it was fine. He met them, i.e. the house was not fine. They said it."] * 20,
    *["In the house they met. The doctor said it, the garden was fine today. We met them in the cold."] * 20,
]


@pytest.fixture(scope="module")
def ends(spark):
    df = spark.createDataFrame([(t,) for t in CORPUS], "text string").repartition(4)
    return sentences.learn_sentence_ends(df, "text").cache()


def split(spark, ends, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "row int, text string").repartition(2)
    got = {r.row: r.lines for r in sentences.learned_sentences(df, ends, "text", "lines").collect()}
    return [got[i] for i in range(len(texts))]


def test_abbreviations_are_found_without_labels(ends):
    assert {r.word for r in ends.filter("abbreviation").collect()} == {"dr", "mr", "e.g", "i.e"}


def test_scores_follow_the_published_formula(spark):
    df = spark.createDataFrame([("a b. dr. x dr. y dr z. 12. 12. ..",)], "text string")
    got = {r.word: r for r in sentences.rate_abbreviations(sentences.word_types(df, "text")).collect()}
    counts = {"a": (0, 1), "b": (1, 0), "dr": (2, 1), "x": (0, 1), "y": (0, 1), "z": (1, 0), "12": (2, 0)}
    assert {w: (r.n_stop, r.n_other) for w, r in got.items()} == counts
    stops, words = 6, 10
    null = 2 * math.log(stops / words) + math.log(1 - stops / words)
    rule = 2 * math.log(0.99) + math.log(0.01)
    assert got["dr"].score == pytest.approx(-2 * (null - rule) * math.exp(-2) * 2**-1)
    assert got["12"].score == got["a"].score == 0


def test_sentences_by_hand(spark, ends):
    cases = {
        "They met Dr. Smith. It was fine.": "They met Dr. Smith.\nIt was fine.",
        "See e.g. the house. We met (Mr. Jones).  He said so!": "See e.g. the house.\nWe met (Mr. Jones).\nHe said so!",
        # After an abbreviation, a word that is small elsewhere and large only where sentences begin starts one.
        "They met the Dr. The house was cold.": "They met the Dr.\nThe house was cold.",
        "Is it 3.5 or 4. place? No. 12. house": "Is it 3.5 or 4. place?\nNo.\n12. house",
        "J. Smith met A. B. Jones.": "J. Smith met A. B. Jones.",
        "One\n two .  Three?\r\nFour": "One\ntwo .\nThree?\nFour",
        "Dr.\nSmith": "Dr.\nSmith",
        "   ": "",
        "": "",
        "...": "...",
    }
    assert split(spark, ends, *cases, None) == [*cases.values(), None]


def test_long_texts_and_no_rows(spark, ends):
    text = "We met Dr. Smith. " * 3000
    assert split(spark, ends, text) == ["\n".join(["We met Dr. Smith."] * 3000)]
    none = spark.createDataFrame([], "text string")
    assert sentences.learn_sentence_ends(none, "text").collect() == []
    assert split(spark, sentences.learn_sentence_ends(none, "text"), "An oak. The elm.") == ["An oak.\nThe elm."]
    assert sentences.learned_sentences(none.withColumn("n", F.lit(1)), ends, "text", "text").columns == ["n", "text"]


def test_long_words_and_white_space_cost_no_more_than_their_length(spark, ends):
    """A word of 200,000 letters, as many full stops and as much white space: each is passed over once."""
    size = 200_000
    for text, want in (
        ("It was. " + "q" * size + ". It was" + " " * size + "cold.", "It was.\n" + "q" * size + ".\nIt was" + " " * size + "cold."),
        ("." * size + "x. They said", "." * size + "x.\nThey said"),
    ):
        started = time.monotonic()
        assert split(spark, ends, text) == [want]
        df = spark.createDataFrame([(text,)], "text string")
        assert sentences.word_types(df, "text").count() > 1
        assert time.monotonic() - started < 20


def test_word_counts_against_a_plain_pass_over_odd_marks(spark):
    """Marks of every kind at the ends of pieces: which words stand inside a sentence follows from the piece before."""
    rng = random.Random(9)
    signs = [".", "!", "?", ":", ")", "\"", "-", "'", "$", "a", "B", "é", "Ж", "7", "日", "\U0001d400", "🙂", " ", " ", "\n", " ", "　"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(400)] + [None, "", " \n "]
    want = defaultdict(lambda: [0, 0, 0, 0])
    letter = lambda c: unicodedata.category(c)[0] in "LN"
    for text in texts:
        before = None
        for piece in (text or "").split():
            tail = next((piece[at + 1 :] for at in range(len(piece) - 1, -1, -1) if letter(piece[at])), piece)
            closed, start = any(c in ".!?:" for c in tail), next((at for at, c in enumerate(piece) if letter(c)), None)
            if start is not None:
                run = start
                while run < len(piece) and (letter(piece[run]) or piece[run] in ".'-"):
                    run += 1
                while not letter(piece[run - 1]):
                    run -= 1
                word, kind = piece[start:run], unicodedata.category(piece[start])
                one = want[word.lower()]
                one[0 if piece[run : run + 1] == "." else 1] += 1
                one[2] += kind == "Ll"
                one[3] += kind == "Lu" and before is False
            before = closed
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = {r.word: [r.n_stop, r.n_other, r.n_small, r.n_large_inside] for r in sentences.word_types(df, "text").collect()}
    assert {w: (c, want.get(w)) for w, c in got.items() if c != want.get(w)} == {} and len(got) == len(want)
