"""ROUGE scores of predictions against references (Lin 2004).

N-grams and the whole texts' common subsequence are scored in the row, without a shuffle; sentences against each other as
rows of their own.

Tokens are lower-cased words without stemming unless another tokenizer is given. Every score is a struct of
`precision`, `recall` and `f1`; an empty side scores 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from precis.functions.text import let, newline_sentences
from precis.functions.tokens import ngrams, word_tokens
from precis.operators.vocabulary import Tokenizer
from precis.session import stored


def precision_recall_f1(n: Column) -> Column:
    """The three scores from a struct of whole numbers: `hits`, `predicted`, `expected`; F1 is 2 hits / (p + e)."""

    def share(of: Column, total: Column) -> Column:
        return F.when((n["predicted"] > 0) & (n["expected"] > 0), of / total).otherwise(F.lit(0.0))

    return F.struct(
        share(n["hits"], n["predicted"]).alias("precision"),
        share(n["hits"], n["expected"]).alias("recall"),
        share(2 * n["hits"], n["predicted"] + n["expected"]).alias("f1"),
    )


def number_repeats(items: Column) -> Column:
    """Each item joined with the number of its repeat, so that a bag of items becomes a set.

    Sorted, equal items stand together: where a run starts tells how far into it an item is.
    """

    def number(ordered: Column) -> Column:
        places = F.when(F.size(ordered) > 0, F.sequence(F.lit(1), F.size(ordered))).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            places, lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2))
        )
        return let(starts, lambda bound: F.flatten(F.transform(bound, lambda start, at: run(ordered, bound, start, at))))

    def run(ordered: Column, starts: Column, start: Column, at: Column) -> Column:
        end = F.coalesce(F.get(starts, at + 1), F.size(ordered) + 1)
        item = F.get(ordered, start - 1)
        return F.transform(
            F.sequence(F.lit(0), end - start - 1), lambda k: F.concat(item, F.lit("\t"), k.cast("string"))
        )

    return F.when(F.size(items) > 0, let(F.sort_array(items), number)).otherwise(F.array().cast("array<string>"))


def overlap(left: Column, right: Column) -> Column:
    """How many items two bags share, repeats counted as often as both have them."""
    return F.size(F.array_intersect(number_repeats(left), number_repeats(right)))


def ngram_scores(predicted: Column, expected: Column, n: int) -> Column:
    """Shared n-grams of two token arrays."""

    def count(sides: Column) -> Column:
        return F.struct(
            overlap(sides["predicted"], sides["expected"]).alias("hits"),
            F.size(sides["predicted"]).alias("predicted"),
            F.size(sides["expected"]).alias("expected"),
        )

    sides = F.struct(ngrams(predicted, n).alias("predicted"), ngrams(expected, n).alias("expected"))
    return let(let(sides, count), precision_recall_f1)


def _places(tokens: list[str]) -> dict[str, int]:
    """Per token a number whose bits mark where it stands."""
    places: dict[str, int] = {}
    for i, token in enumerate(tokens):
        places[token] = places.get(token, 0) | (1 << i)
    return places


def _open_places(
    places: dict[str, int], length: int, tokens: list[str], start: int | None = None
) -> Iterator[int]:
    """After each of `tokens`, the places of the other side that a longest common subsequence leaves open.

    A whole row of the usual table in one number (Crochemore et al. 2001).
    """
    everywhere = (1 << length) - 1
    still_open = everywhere if start is None else start
    for token in tokens:
        hit = still_open & places.get(token, 0)
        still_open = ((still_open + hit) | (still_open - hit)) & everywhere
        yield still_open


def lcs_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence."""
    still_open = (1 << len(right)) - 1
    for still_open in _open_places(_places(right), len(right), left):
        pass
    return len(right) - still_open.bit_count()


def _open_places_backwards(places: dict[str, int], length: int, tokens: list[str]) -> Iterator[int]:
    """The rows of `_open_places` from the last to the one before any token.

    Every so many rows are kept and those between worked out again, so that memory grows with the root of the length.
    """
    step = isqrt(len(tokens)) + 1
    marks = [(1 << length) - 1]
    for n, still_open in enumerate(_open_places(places, length, tokens), 1):
        if n % step == 0:
            marks.append(still_open)
    for n in range(len(marks) - 1, -1, -1):
        block = [marks[n]]
        block.extend(_open_places(places, length, tokens[n * step : (n + 1) * step - 1], marks[n]))
        yield from reversed(block)


def lcs_places(reference: list[str], places: dict[str, int], prediction: list[str]) -> int:
    """The reference places that one longest common subsequence covers, as bits.

    Walked back from the end: equal tokens are taken, else the reference steps back unless only stepping back in the
    prediction keeps the length.
    """
    rows = _open_places_backwards(places, len(reference), prediction)
    here, before = next(rows), next(rows, 0)

    def length(i: int, row: int) -> int:
        return i - (row & ((1 << i) - 1)).bit_count()

    covered, i, j = 0, len(reference), len(prediction)
    while i > 0 and j > 0:
        taken = reference[i - 1] == prediction[j - 1]
        back = not taken and length(i, before) > length(i - 1, here)
        if taken:
            covered |= 1 << (i - 1)
        if taken or not back:
            i -= 1
        if taken or back:
            j -= 1
            here, before = before, next(rows, 0)
    return covered


SCORES = StructType([StructField(name, DoubleType()) for name in ("precision", "recall", "f1")])


def _shares(hits: list[int], predicted: list[int], expected: list[int]) -> pd.DataFrame:
    """The three scores per row; zero where a side is empty."""
    n = pd.DataFrame({"hits": hits, "predicted": predicted, "expected": expected}, dtype="float64")
    both = (n["predicted"] > 0) & (n["expected"] > 0)
    return pd.DataFrame(
        {
            "precision": (n["hits"] / n["predicted"]).where(both, 0.0),
            "recall": (n["hits"] / n["expected"]).where(both, 0.0),
            "f1": (2 * n["hits"] / (n["predicted"] + n["expected"])).where(both, 0.0),
        }
    )


@F.pandas_udf(SCORES)
def lcs_scores(predicted: pd.Series, expected: pd.Series) -> pd.DataFrame:
    """Longest common subsequence of two token arrays."""
    pairs = [(list(p), list(e)) for p, e in zip(predicted, expected, strict=True)]
    return _shares([lcs_length(p, e) for p, e in pairs], [len(p) for p, _ in pairs], [len(e) for _, e in pairs])


@F.pandas_udf(ArrayType(IntegerType()))
def matched_places(expected: pd.Series, predicted: pd.Series) -> pd.Series:
    """The places of one token array that its longest common subsequence with another covers, from 0."""

    def places(reference: list[str], prediction: list[str]) -> list[int]:
        covered = lcs_places(reference, _places(reference), prediction)
        return [i for i in range(len(reference)) if covered >> i & 1]

    return pd.Series([places(list(e), list(p)) for e, p in zip(expected, predicted, strict=True)], index=expected.index, dtype=object)


def add_union_lcs(df: DataFrame, predicted: str, expected: str, into: str) -> DataFrame:
    """`df` with a score of two columns of sentences, each an array of tokens: reference tokens that the prediction's
    sentences cover together, no token more often than predicted.

    A pair of a reference sentence and a predicted one that share a token is a row: its common subsequence is all that is
    worked out outside Spark. The places that a reference sentence's pairs cover are put together per sentence, their
    tokens per row of `df`, so no task holds all pairs of a row. Every row stays, whatever its columns hold.
    """
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows-to-score")
    sentence = rows.select("_row", F.col(predicted).alias("_p"), F.posexplode(expected).alias("_at", "_e"))
    pairs = sentence.select("_row", "_at", "_e", F.explode("_p").alias("_p")).filter(F.arrays_overlap("_e", "_p"))
    found = pairs.select("_row", "_at", "_e", matched_places("_e", "_p").alias("_places"))
    union = found.groupBy("_row", "_at").agg(F.first("_e").alias("_e"), F.array_distinct(F.flatten(F.collect_list("_places"))).alias("_places"))
    tokens = union.select("_row", F.transform("_places", lambda i: F.get("_e", i)).alias("_tokens"))
    covered = tokens.groupBy("_row").agg(F.flatten(F.collect_list("_tokens")).alias("_covered"))
    none = F.array().cast("array<string>")

    def count(bags: Column) -> Column:
        return F.struct(
            overlap(bags["covered"], bags["predicted"]).alias("hits"),
            F.size(bags["predicted"]).alias("predicted"),
            F.size(bags["expected"]).alias("expected"),
        )

    bags = F.struct(
        F.coalesce("_covered", none).alias("covered"), F.coalesce(F.flatten(predicted), none).alias("predicted"), F.coalesce(F.flatten(expected), none).alias("expected")
    )
    scored = rows.join(covered, "_row", "left").withColumn(into, let(let(bags, count), precision_recall_f1))
    return scored.drop("_row", "_covered")


def tokens_of(text: Column, tokenize: Tokenizer = word_tokens) -> Column:
    """Tokens of a text; none of null."""
    return tokenize(F.coalesce(text, F.lit("")))


def tokens_per_line(text: Column, tokenize: Tokenizer = word_tokens) -> Column:
    """Token arrays of a text's lines, those without a token left out."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), tokenize)
    return F.filter(lines, lambda tokens: F.size(tokens) > 0)


def rouge_n(prediction: Column, reference: Column, n: int, tokenize: Tokenizer = word_tokens) -> Column:
    """Shared n-grams of two texts."""
    return ngram_scores(tokens_of(prediction, tokenize), tokens_of(reference, tokenize), n)


def rouge_l(prediction: Column, reference: Column, tokenize: Tokenizer = word_tokens) -> Column:
    """Longest common subsequence of the whole texts."""
    return lcs_scores(tokens_of(prediction, tokenize), tokens_of(reference, tokenize))


def add_rouge_lsum(df: DataFrame, prediction: str, reference: str, into: str, tokenize: Tokenizer = word_tokens) -> DataFrame:
    """`df` with the union of the longest common subsequences per reference sentence; sentences stand on lines of their own."""
    lines = df.withColumn("_predicted", tokens_per_line(F.col(prediction), tokenize)).withColumn("_expected", tokens_per_line(F.col(reference), tokenize))
    return add_union_lcs(lines, "_predicted", "_expected", into).drop("_predicted", "_expected")


def score_texts(
    df: DataFrame, prediction: str, reference: str, tokenize: Tokenizer = word_tokens, sentences: bool = True
) -> DataFrame:
    """`rouge1`, `rouge2`, `rougeL` and `rougeLsum` (F1) added to each row.

    `sentences` puts each sentence on its own line first, which the last score needs. Each text is cut into tokens
    once for all four.
    """
    kept = df.columns
    for side, col in (("predicted", prediction), ("expected", reference)):
        text = newline_sentences(F.col(col)) if sentences else F.col(col)
        df = df.withColumn(f"_{side}_lines", tokens_per_line(text, tokenize))
    for side in ("predicted", "expected"):
        df = df.withColumn(f"_{side}", F.flatten(f"_{side}_lines"))
    predicted, expected = F.col("_predicted"), F.col("_expected")
    df = add_union_lcs(df, "_predicted_lines", "_expected_lines", "_sum")
    return df.select(
        *kept,
        ngram_scores(predicted, expected, 1)["f1"].alias("rouge1"),
        ngram_scores(predicted, expected, 2)["f1"].alias("rouge2"),
        lcs_scores(predicted, expected)["f1"].alias("rougeL"),
        F.col("_sum.f1").alias("rougeLsum"),
    )
