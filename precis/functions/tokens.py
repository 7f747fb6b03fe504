"""Token and id array functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from precis.functions.text import let

PAD_ID, END_ID, UNKNOWN_ID = 0, 1, 2
FIRST_TOKEN_ID = 3
# Fixed value. The label id that a loss function skips.
IGNORE_ID = -100


def word_tokens(col: Column) -> Column:
    """Runs of ASCII letters and digits of the lower-cased text."""
    return F.regexp_extract_all(F.lower(col), F.lit("[a-z0-9]+"), F.lit(0))


_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123)]] = True


def lowered_words(texts: pa.Array, most: int | None = None) -> pa.ListArray:
    """`word_tokens` of a batch of texts that are lower-cased already, of each at most the first `most`; null has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    begins = offsets - low
    solid = np.concatenate([[False], _IN_WORD[data], [False]])
    # A word also ends where its text does.
    apart = np.zeros(len(data) + 1, bool)
    apart[begins] = True
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | apart))
    ends = np.flatnonzero(solid[:-1] & (~solid[1:] | apart))
    to = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(to), pa.py_buffer(data[solid[1:-1]]))
    bounds = np.searchsorted(starts, begins)
    sizes = np.diff(bounds)
    if most is not None and len(sizes) and int(sizes.max()) > most:
        words = words.filter(pa.array(np.arange(len(starts)) - np.repeat(bounds[:-1], sizes) < most))
        bounds = np.concatenate([[0], np.cumsum(np.minimum(sizes, most))])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), words)


def sentence_tokens(col: Column) -> Column:
    """Words as in `word_tokens`, and the marks that end sentences as tokens of their own."""
    return F.regexp_extract_all(F.lower(col), F.lit("[a-z0-9]+|[.!?]"), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of `n` tokens, each joined by a space."""
    if n == 1:
        return tokens

    def runs(bound: Column) -> Column:
        starts = F.when(F.size(bound) >= n, F.sequence(F.lit(1), F.size(bound) - n + 1)).otherwise(
            F.array().cast("array<int>")
        )
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(bound, i - 1 + k) for k in range(n)]))

    return let(tokens, runs)


def pad_to_length(ids: Column, length: int | Column, pad_id: int = PAD_ID) -> Column:
    """Fill up to `length` on the right; longer arrays stay as they are."""
    length = length if isinstance(length, Column) else F.lit(length)
    missing = F.greatest(F.lit(0), (length - F.size(ids)).cast("int"))
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def mask_labels(ids: Column, pad_id: int = PAD_ID, ignore: int = IGNORE_ID) -> Column:
    """Padding in labels becomes the id that the loss skips."""
    return F.transform(ids, lambda i: F.when(i == pad_id, F.lit(ignore)).otherwise(i))


def unmask_labels(ids: Column, pad_id: int = PAD_ID, ignore: int = IGNORE_ID) -> Column:
    """The reverse of `mask_labels`."""
    return F.transform(ids, lambda i: F.when(i == ignore, F.lit(pad_id)).otherwise(i))


def generated_length(ids: Column, pad_id: int = PAD_ID, ignore: int = IGNORE_ID) -> Column:
    """How many ids are neither padding nor skipped."""
    return F.size(F.filter(ids, lambda i: (i != pad_id) & (i != ignore)))
