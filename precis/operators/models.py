"""Any summarization model, as a function from texts to summaries, on a DataFrame column."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from precis.functions.text import first_words
from precis.operators.rows import with_prefix

Model = Callable[[list[str]], list[str]]
BATCH_SIZE = 8


def in_batches(texts: list[str], batch_size: int) -> list[list[int]]:
    """The places of the texts in batches of similar length: longest first, so a batch's texts need little padding."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    return [order[at : at + batch_size] for at in range(0, len(order), batch_size)]


def model_function(spark: SparkSession, model: Model, batch_size: int = BATCH_SIZE, by_length: bool = True) -> Callable[[Column], Column]:
    """The model as a column function. It is sent to each executor once and unpacked once per task.

    Nulls are passed by: they give null. A model pads a batch to its longest text, so with `by_length` the texts of an
    Arrow batch (`spark.sql.execution.arrow.maxRecordsPerBatch` rows, the run that is in memory anyway) reach it in order
    of their length; each summary comes out in its text's row. A model whose answers depend on what else is in a batch
    wants `by_length=False`.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf(StringType())
    def apply_model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = cloudpickle.loads(packed.value)
        for batch in batches:
            texts = batch.dropna()
            given = texts.tolist()
            out: list[str | None] = [None] * len(given)
            places = in_batches(given, batch_size) if by_length else [list(range(at, min(at + batch_size, len(given)))) for at in range(0, len(given), batch_size)]
            for some in places:
                for place, summary in zip(some, run([given[i] for i in some]), strict=True):
                    out[place] = summary
            yield pd.Series(out, index=texts.index, dtype=object).reindex(batch.index)

    return apply_model


def padded_sizes(df: DataFrame, col: str, batch_size: int = BATCH_SIZE) -> DataFrame:
    """One row `(texts, chars, as_they_come, by_length)`: what a model reads of the column's texts, in characters.

    The texts alone, and padded to the longest of each batch, in the order of rows and in order of length.
    """

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].dropna().tolist()
            plain = [len(texts[i]) for i in range(len(texts))]
            rows = [range(at, min(at + batch_size, len(texts))) for at in range(0, len(texts), batch_size)]
            padded = [sum(len(some) * max(plain[i] for i in some) for some in order) for order in (rows, in_batches(texts, batch_size))]
            yield pd.DataFrame({"texts": [len(texts)], "chars": [sum(plain)], "as_they_come": [padded[0]], "by_length": [padded[1]]})

    sizes = df.select(F.col(col).alias("text")).mapInPandas(measure, "texts bigint, chars bigint, as_they_come bigint, by_length bigint")
    return sizes.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sizes.columns))


def summarize(
    df: DataFrame,
    col: str,
    model: Model,
    batch_size: int = BATCH_SIZE,
    prefix: str | None = "summarize: ",
    max_tokens: int | None = None,
    into: str = "summary",
) -> DataFrame:
    """A summary per row, from the prefixed text; `max_tokens` cuts the input for a model that does not do so itself."""
    text = with_prefix(F.col(col), prefix)
    if max_tokens is not None:
        text = first_words(text, max_tokens)
    return df.withColumn(into, model_function(df.sparkSession, model, batch_size)(text))


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | StructType
) -> DataFrame:
    """`fn` on Arrow batches of rows; it may drop rows and return other columns."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return df.mapInPandas(each, schema)
