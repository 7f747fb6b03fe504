"""Vocabulary, encoding and decoding as table jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.tokens import (
    END_ID,
    FIRST_TOKEN_ID,
    PAD_ID,
    UNKNOWN_ID,
    generated_length,
    lowered_words,
    mask_labels,
    pad_to_length,
    unmask_labels,
    word_tokens,
)
from precis.operators.lookups import looked_up, read_by_place
from precis.operators.running import with_totals_before
from precis.session import stored

Tokenizer = Callable[[Column], Column]
VOCAB_SIZE = 32_000
MAX_SOURCE_LENGTH = 1024
MAX_TARGET_LENGTH = 128


def count_tokens(df: DataFrame, text: str, tokenize: Tokenizer = word_tokens) -> DataFrame:
    """`(token, count)`. Counts are combined before the shuffle, so a frequent token costs one row per input task.

    Plain words are cut and counted by Arrow batch, which costs less than a pattern and a row for each of them.
    """
    if tokenize is word_tokens:
        counted = df.select(F.lower(F.col(text)).alias("text")).mapInArrow(_count_words, "token string, n bigint")
        return counted.groupBy("token").agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("count"))
    return df.select(F.explode(tokenize(F.col(text))).alias("token")).groupBy("token").agg(F.count("*").alias("count"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = pc.value_counts(lowered_words(batch.column(0)).values)
        yield pa.RecordBatch.from_arrays([counted.field(0), counted.field(1)], names=["token", "n"])


def build_vocab(df: DataFrame, text: str, size: int = VOCAB_SIZE, tokenize: Tokenizer = word_tokens) -> DataFrame:
    """`(token, id, count)` of the `size` most frequent tokens, ties in token order; ids follow the special ones.

    How many tokens occur how often says first which count the last of them has: that table has one row per count,
    few even in a large corpus. Only tokens of that count or more are ranked then, all of them over all tasks: words that
    occur once are a large part of a corpus's words.
    """
    counts = stored(count_tokens(df, text, tokenize), "token-counts")
    ties = counts.groupBy("count").agg(F.count("*").alias("tokens"))
    # Rows are distinct counts; tokens above a count are those of all larger ones.
    above = F.sum("tokens").over(Window.orderBy(F.desc("count")).rowsBetween(Window.unboundedPreceding, -1))
    needed = ties.withColumn("above", F.coalesce(above, F.lit(0))).filter(F.col("above") < size)
    least = needed.agg(F.min("count")).scalar()
    ranked = with_totals_before(counts.filter(F.col("count") >= least).withColumn("one", F.lit(1)), [F.desc("count"), F.col("token")], {"place": "one"}, "ranked-tokens")
    return ranked.filter(F.col("place") < size).select("token", (F.col("place") + FIRST_TOKEN_ID).cast("int").alias("id"), "count")


def encode(
    df: DataFrame,
    vocab: DataFrame,
    cols: dict[str, tuple[str, int]],
    tokenize: Tokenizer = word_tokens,
    keep: list[str] | None = None,
) -> DataFrame:
    """`df` with an id array per entry of `cols`, which maps the new name to (text column, longest length).

    Each array ends in the end id and has no more than its length, that id included. A column of a new name is
    replaced. Tokens that the vocabulary lacks are unknown; nulls are empty texts. `keep` names the other columns that
    are wanted, all by default: texts that have their ids need not be moved.
    """
    texts = {name: F.coalesce(F.col(text), F.lit("")) for name, (text, _) in cols.items()}
    if tokenize is word_tokens:  # cut by Arrow batch
        arrays = {name: F.lower(text) for name, text in texts.items()}
        cuts = {name: partial(lowered_words, most=length - 1) for name, (_, length) in cols.items()}
    else:
        arrays = {name: F.slice(tokenize(text), 1, cols[name][1] - 1) for name, text in texts.items()}
        cuts = None
    found = looked_up(df, vocab, arrays, "token", "id", keep=keep, cuts=cuts)
    for name in cols:
        known = F.transform(F.col(name), lambda i: F.coalesce(i, F.lit(UNKNOWN_ID)))
        found = found.withColumn(name, F.concat(known, F.array(F.lit(END_ID))))
    return found


def encode_pairs(
    df: DataFrame,
    vocab: DataFrame,
    max_source_length: int = MAX_SOURCE_LENGTH,
    max_target_length: int = MAX_TARGET_LENGTH,
    val_max_target_length: int | None = None,
    validation: bool = False,
    pad_to_max_length: bool = False,
    ignore_pad_token_for_loss: bool = True,
    tokenize: Tokenizer = word_tokens,
) -> DataFrame:
    """`(text, summary)` pairs with `input_ids` and `labels`, padded and masked as asked; other columns stay.

    Evaluation and prediction rows take the validation limit for their targets, which is the target limit when unset.
    """
    target = max_target_length
    if validation and val_max_target_length is not None:
        target = val_max_target_length
    encoded = encode(df, vocab, {"input_ids": ("text", max_source_length), "labels": ("summary", target)}, tokenize)
    if not pad_to_max_length:
        return encoded
    inputs = pad_to_length(F.col("input_ids"), max_source_length)
    labels = pad_to_length(F.col("labels"), target)
    if ignore_pad_token_for_loss:
        labels = mask_labels(labels)
    return encoded.withColumn("input_ids", inputs).withColumn("labels", labels)


def decode(df: DataFrame, vocab: DataFrame, cols: list[str], lengths: dict[str, str] | None = None) -> DataFrame:
    """`df` with the text of each id array in its place: special ids dropped, tokens joined by a space.

    No space stands before a sentence's end mark, for ids that were made with `sentence_tokens`. Ids that the vocabulary
    lacks are left out. Ids follow each other without gaps, so a token is read by its place, see `read_by_place`.

    `lengths` maps id columns to new columns with their number of ids that are neither padding nor skipped.
    """
    for name, length in (lengths or {}).items():
        df = df.withColumn(length, generated_length(F.col(name)))
    arrays = {
        name: F.filter(
            unmask_labels(F.coalesce(F.col(name), F.array().cast("array<int>")), PAD_ID),
            lambda i: i >= FIRST_TOKEN_ID,
        )
        for name in cols
    }
    found = read_by_place(df, vocab, arrays, "id", "token")
    for name in cols:
        found = found.withColumn(name, F.regexp_replace(F.concat_ws(" ", F.col(name)), " (?=[.!?])", ""))
    return found
