from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from precis.functions import text as txt
from precis.operators.cleaning import clean_reviews

CASES = [
    (None, 5, ""),
    ("", 5, ""),
    ("   ", 5, ""),
    ("a b c. d e f", 8, "a b c. d e f"),
    ("a b c. d e f", 5, "a b c."),
    ("a b c. d e f", 4, "a b c"),
    ("a b c. d e f", 2, ""),
    ("a.\tb", 3, "a.\tb"),
    ("<b>Hi</b> you&#34; there", 9, "Hi  you  there"),
    ("x &amp; y", 9, "x &amp; y"),
    ("[[VIDEOID:abc]]good\r\nlens", 9, "good lens"),
    ("? ! ok", 9, "? ! ok"),
    ("? ! ok", 6, "? !"),
    ("a ", 3, "a"),
    ("a.\x1cb c", 9, "a.\x1cb c"),
    ("one.  two", 4, "one."),
    ("keeps  as it is", 9, "keeps  as it is"),
    ("unclosed <b tag", 9, "unclosed <b tag"),
]


@pytest.mark.parametrize("budget", sorted({budget for _, budget, _ in CASES}))
def test_clean_text_hand_worked(values, budget):
    rows = [((text,), want) for text, b, want in CASES if b == budget]
    got = values([row for row, _ in rows], "text string", txt.clean_text(F.col("text"), budget))
    assert got == [want for _, want in rows]


def longest_affordable_prefix(text: str, budget: int) -> str:
    """By walking the characters: the cost rises with each space and with each new fragment."""
    cost, kept, i, start = 1, 0, 0, 0
    while i < len(text):
        if text[i] in "?!." and i + 1 < len(text) and text[i + 1] in txt.WHITESPACE:
            if cost > budget:
                return text[:kept].strip(txt.WHITESPACE)
            kept = i
            end = i + 1
            while end < len(text) and text[end] in txt.WHITESPACE:
                end += 1
            cost += 1 + text[i:end].count(" ")
            if cost > budget:
                return text[:kept].strip(txt.WHITESPACE)
            kept = start = i = end
            cost += 1
            continue
        cost += text[i] == " "
        i += 1
    return text[: len(text) if cost <= budget else kept].strip(txt.WHITESPACE)


@pytest.mark.parametrize("budget", [0, 1, 3, 6, 20])
def test_truncation_against_a_walk_over_the_characters(values, budget):
    rng = random.Random(budget)
    texts = ["".join(rng.choice("ab .?!\t 　é") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts = [text.strip(txt.WHITESPACE) for text in texts]
    got = values([(t,) for t in texts], "text string", txt.truncate_at_sentence(F.col("text"), budget))
    assert got == [longest_affordable_prefix(t, budget) for t in texts]


def test_cost_stays_in_budget_and_cleaning_again_is_no_longer(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select(txt.clean_text(F.col("text"), 30).alias("once"))
    df = df.withColumn("twice", txt.clean_text(F.col("once"), 30))
    assert df.filter("length(twice) > length(once)").count() == 0
    assert df.filter(txt.word_count(F.col("once")) > 30).count() == 0


def test_sentences(values):
    got = values([(" One. Two!\n\nthree \n ? four",), ("",), ("  ",)], "text string", txt.sentences(F.col("text")))
    assert got == [["One.", "Two!", "three", "?", "four"], [], []]


def test_clean_reviews_drops_rows_that_lose_a_side(spark):
    rows = [(1, "Good", "Nice lens."), (2, "<b></b>", "text"), (3, "head", None), (4, "head", "&#34;")]
    df = spark.createDataFrame(rows, "product_id int, review_headline string, review_body string")
    out = clean_reviews(df)
    assert out.columns == df.columns
    assert [tuple(r) for r in out.collect()] == [(1, "Good", "Nice lens.")]


def test_each_text_is_cleaned_once(spark):
    """A filter pushed below the cleaning would copy the expression into it."""
    df = spark.createDataFrame([("a", "b", "c")], "product_id string, review_headline string, review_body string")
    plan = clean_reviews(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2
