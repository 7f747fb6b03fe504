"""Cleaning of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from precis.functions.text import clean_text


def replace_non_empty(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Columns replaced by `new`, in place; rows where one of the new values is null or empty are dropped.

    A filter above a projection is pushed below it with the expression copied in, so each value would be worked out
    twice. Going through a one-element array that is filtered and unpacked works it out once.
    """
    row = F.struct(*[value.alias(name) for name, value in new.items()])
    # Nested: the values are bound before the test reads them.
    full = F.filter(F.array(row), lambda r: _all_full(r, list(new)))
    unpacked = df.select("*", F.explode(full).alias("_new"))
    return unpacked.select(*[F.col(f"_new.{c}").alias(c) if c in new else F.col(c) for c in df.columns])


def _all_full(row: Column, names: list[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & (F.length(row[name]) > 0)
    return test


def clean_column(df: DataFrame, col: str, max_tokens: int) -> DataFrame:
    """One text column cleaned; rows left with no text are dropped."""
    return replace_non_empty(df, {col: clean_text(F.col(col), max_tokens)})


def clean_reviews(
    df: DataFrame,
    body: str = "review_body",
    headline: str = "review_headline",
    body_tokens: int = 100,
    headline_tokens: int = 20,
) -> DataFrame:
    """Bodies and headlines cleaned to their budgets; rows that lose one of them are dropped."""
    return replace_non_empty(
        df,
        {
            headline: clean_text(F.col(headline), headline_tokens),
            body: clean_text(F.col(body), body_tokens),
        },
    )
