"""Ids and texts by a published subword tokenizer, given as a file of the tokenizers library."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from precis.functions.tokens import IGNORE_ID

# The library holds some hundred bytes for each token of the texts that it is given at once, and a Python list of ids 36 for
# each: both are held for so many characters or ids only, whatever a batch holds.
_CHARS_AT_ONCE = 250_000


def _opened(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    return tokenizer


def _portions(sizes: list[int]) -> Iterator[slice]:
    """Runs of rows of about `_CHARS_AT_ONCE`, a longer row alone."""
    start, held = 0, 0
    for at, size in enumerate(sizes):
        if at > start and held + size > _CHARS_AT_ONCE:
            yield slice(start, at)
            start, held = at, 0
        held += size
    yield slice(start, len(sizes))


def subword_ids(spark: SparkSession, path: str, max_length: int | None = None, end_id: int | None = None) -> Callable[[Column], Column]:
    """A column function from texts to ids, cut to `max_length` of them, the end id at the end included; null is an empty text.

    The file is read here and sent to each executor once, so executors need not have it.
    """
    with open(path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    end = [] if end_id is None else [end_id]
    most = None if max_length is None else max(0, max_length - len(end))

    @F.arrow_udf(ArrayType(IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _opened(sent.value)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.utf8_length(batch), 0)).tolist()
            ids, lengths = [np.empty(0, np.int32)], [0]
            for some in _portions(sizes):
                texts = [t or "" for t in batch[some.start : some.stop].to_pylist()]
                for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
                    ids.append(np.asarray(e.ids[:most] + end, np.int32))
                    lengths.append(len(ids[-1]))
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(np.concatenate(ids)))

    return encode


def subword_texts(spark: SparkSession, path: str, skip: tuple[int, ...] = ()) -> Callable[[Column], Column]:
    """A column function from ids to texts; ids that the loss skips, those of `skip` (padding, end) and null go; null is null."""
    with open(path, encoding="utf-8") as file:
        sent = spark.sparkContext.broadcast(file.read())
    dropped = {IGNORE_ID, *skip}

    @F.arrow_udf(StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = _opened(sent.value)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.list_value_length(batch), 0)).tolist()
            out = [pa.array([], pa.string())]
            for some in _portions(sizes):
                part = batch[some.start : some.stop]
                rows = [None if ids is None else [i for i in ids if i is not None and i not in dropped] for ids in part.to_pylist()]
                texts = iter(tokenizer.decode_batch([r for r in rows if r is not None], skip_special_tokens=False))
                out.append(pa.array([None if r is None else next(texts) for r in rows], pa.string()))
            yield pa.concat_arrays(out)

    return decode


def encode_subwords(df: DataFrame, path: str, cols: dict[str, tuple[str, int | None]], end_id: int | None = None) -> DataFrame:
    """`df` with an id array per entry of `cols`, which maps the new name to (text column, longest length or None).

    Rows are encoded where they lie, without a shuffle. The arrays suit `pad_to_length`, `mask_labels` and `pad_batches`.
    """
    spark = df.sparkSession
    return df.withColumns({name: subword_ids(spark, path, length, end_id)(F.col(text)) for name, (text, length) in cols.items()})


def decode_subwords(df: DataFrame, path: str, cols: list[str], skip: tuple[int, ...] = ()) -> DataFrame:
    """`df` with the text of each id array in its place."""
    to_text = subword_texts(df.sparkSession, path, skip)
    return df.withColumns({name: to_text(F.col(name)) for name in cols})
