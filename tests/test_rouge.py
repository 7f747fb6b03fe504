from __future__ import annotations

import random
from functools import cache
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from precis.operators import evaluation, rouge

PAIRS = [
    ("the cat sat", "the cat sat on the mat", 2 / 3, 4 / 7, 3),
    ("police killed the gunman", "police kill the gunman", 3 / 4, 1 / 3, 3),
    ("the gunman kill police", "police killed the gunman", 3 / 4, 1 / 3, 2),
    ("", "x", 0, 0, 0),
    ("the the the", "the cat", 2 / 5, 0, 1),
    (None, "x", 0, 0, 0),
    ("Same, text!", "same text", 1, 1, 2),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, p, r) for i, (p, r, *_) in enumerate(PAIRS)], "id int, p string, r string")
    return rouge.score_texts(df, "p", "r").orderBy("id").collect()


def test_hand_worked(scored):
    for row, (p, r, one, two, lcs) in zip(scored, PAIRS, strict=True):
        total = len((p or "").split()) + len(r.split())
        assert row.rouge1 == pytest.approx(one)
        assert row.rouge2 == pytest.approx(two)
        assert row.rougeL == pytest.approx(2 * lcs / total)
        assert row.rougeLsum == pytest.approx(2 * lcs / total)  # one sentence a side


def brute_lcs(a, b):
    @cache
    def go(i, j):
        if i == len(a) or j == len(b):
            return 0
        return 1 + go(i + 1, j + 1) if a[i] == b[j] else max(go(i + 1, j), go(i, j + 1))

    return go(0, 0)


def test_lcs_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        a, b = (tuple(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(2))
        best = brute_lcs(a, b)
        assert rouge.lcs_length(list(a), list(b)) == best
        covered = rouge.lcs_places(list(a), rouge._places(list(a)), list(b))
        picked = tuple(t for i, t in enumerate(a) if covered >> i & 1)
        assert len(picked) == best
        assert best == 0 or picked in set(combinations(b, best))


def test_ties_step_back_in_the_reference():
    """Against the table of lengths, walked back by the stated rule."""
    rng = random.Random(8)
    for _ in range(400):
        ref, pred = ([rng.choice("abcd") for _ in range(rng.randint(0, 20))] for _ in range(2))
        best = [[0] * (len(pred) + 1) for _ in range(len(ref) + 1)]
        for i, r in enumerate(ref):
            for j, p in enumerate(pred):
                best[i + 1][j + 1] = best[i][j] + 1 if r == p else max(best[i][j + 1], best[i + 1][j])
        want, i, j = 0, len(ref), len(pred)
        while i and j:
            if ref[i - 1] == pred[j - 1]:
                i, j = i - 1, j - 1
                want |= 1 << i
            elif best[i][j - 1] > best[i - 1][j]:
                j -= 1
            else:
                i -= 1
        assert rouge.lcs_places(ref, rouge._places(ref), pred) == want


def test_union_of_subsequences(spark):
    """Lin's example: of w1..w5 the two predictions cover w1 w2 and w1 w3 w5, four words together."""
    expected = [["w1", "w2", "w3", "w4", "w5"]]
    predicted = [["w1", "w2", "w6", "w7", "w8"], ["w1", "w3", "w8", "w9", "w5"]]
    rows = [
        (predicted, expected, 4), ([["a"]], [["a"], ["a"]], 1),  # predicted once, counts once
        ([], expected, 0), (None, expected, 0), (predicted, None, 0), ([["b"]], [["a"]], 0), (predicted, expected, 4),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row int, p array<array<string>>, e array<array<string>>, want int").repartition(3)
    out = rouge.add_union_lcs(df, "p", "e", "score").orderBy("row").collect()
    assert len(out) == len(rows) and out[0].asDict().keys() == {"row", "p", "e", "want", "score"}
    for r in out:
        assert r.score.recall == pytest.approx(r.want / sum(map(len, r.e)) if r.e and r.p else 0)
        assert r.score.precision == pytest.approx(r.want / sum(map(len, r.p)) if r.e and r.p else 0)


def test_repeats_are_clipped(values):
    column = rouge.overlap(F.col("a"), F.col("b"))
    rows = [(["x", "x", "y"], ["x", "x", "x"]), ([], ["x"]), (["y", "x", "y"], ["y", "y", "x"])]
    assert values(rows, "a array<string>, b array<string>", column) == [2, 0, 3]


def test_sentences_matter_to_the_last_score_only(spark):
    df = spark.createDataFrame([("b c. a d.", "a d. b c.")], "p string, r string")
    row = rouge.score_texts(df, "p", "r").first()
    assert row.rougeLsum == 1 and row.rougeL == 0.5


def test_a_text_scores_one_against_itself(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").filter("text rlike '[a-z] [a-z]'").limit(50)
    out = rouge.score_texts(df.select("text"), "text", "text").agg(*[F.min(c).alias(c) for c in evaluation.SCORES])
    assert [round(v, 12) for v in out.first()] == [1, 1, 1, 1]


def test_means_per_split(spark):
    rows = [("a", 0.5, 3), ("a", 0.25, 4), ("b", 1 / 3, 1)]
    df = spark.createDataFrame(rows, "split string, s double, n int")
    got = sorted(map(tuple, evaluation.mean_metrics(df, ["s"], "n").collect()))
    assert got == [("a", 37.5, 3.5, 2), ("b", 33.3333, 1.0, 1)]
    assert evaluation.mean_metrics(df, ["s"], max_samples=1).filter("split = 'a'").first().samples == 1
