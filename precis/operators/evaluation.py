"""Metrics per split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.stemming import stemmed_tokens
from precis.functions.tokens import word_tokens
from precis.operators.rouge import score_texts
from precis.operators.vocabulary import Tokenizer, decode

SCORES = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def mean_metrics(
    df: DataFrame, scores: list[str], length: str | None = None, split: str = "split", max_samples: int | None = None
) -> DataFrame:
    """One row per split: mean scores in percent to four places, mean length unrounded, number of rows."""
    rows = F.count("*")
    columns = [F.round(F.avg(name) * 100, 4).alias(name) for name in scores]
    if length is not None:
        columns.append(F.avg(length).alias("gen_len"))
    samples = rows if max_samples is None else F.least(F.lit(max_samples).cast("bigint"), rows)
    return df.groupBy(split).agg(*columns, samples.alias("samples"))


def evaluate_texts(
    df: DataFrame,
    prediction: str,
    reference: str,
    split: str = "split",
    tokenize: Tokenizer = stemmed_tokens,
) -> DataFrame:
    """Metrics of predicted texts, on word stems; the length of a prediction is its number of words."""
    one = df.select(
        split,
        F.col(prediction).alias("prediction"),
        F.col(reference).alias("reference"),
        F.size(word_tokens(F.coalesce(F.col(prediction), F.lit("")))).alias("length"),
    )
    return mean_metrics(score_texts(one, "prediction", "reference", tokenize), list(SCORES), "length", split)


def evaluate_ids(
    df: DataFrame,
    vocab: DataFrame,
    prediction: str = "prediction_ids",
    labels: str = "labels",
    split: str = "split",
    tokenize: Tokenizer = stemmed_tokens,
) -> DataFrame:
    """Metrics of predicted ids: decoded, set in sentences, scored on word stems, averaged. Every row counts once."""
    own = df.select(split, prediction, labels)
    texts = decode(own, vocab, [prediction, labels], {prediction: "_length"})
    scored = score_texts(texts, prediction, labels, tokenize)
    return mean_metrics(scored, list(SCORES), "_length", split)
