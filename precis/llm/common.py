"""What several operators share: stored tables, running totals over a sorted table, hashed words of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.functions.text import let
from precis.operators.running import with_totals_before  # noqa: F401
from precis.session import configure
from precis.session import stored as saved  # noqa: F401

# Fixed by the result contracts: what parts words.
SPACES = " \t\n\x0b\f\r"
WORD_GAP = "[ \\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; the session gets the library's settings, such as smaller Arrow batches for long texts."""
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def packed(docs: DataFrame) -> Column:
    """All columns of a row as one, so that no name of theirs meets one of ours."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_r")


def unpacked(docs: DataFrame, **instead: Column) -> list[Column]:
    """The columns of `docs` out of the packed one, some of them given anew."""
    return [instead.get(c, F.col("_r").getField(c)).alias(c) for c in docs.columns]


def words_of(text: Column) -> Column:
    """The words of a text, runs of anything but ASCII white space; none for null."""
    return let(
        F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_GAP)),
    )


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


# Words and shingles as 64-bit numbers, for a batch of texts at a time

#: Small enough that a piece's numbers stay in a core's cache.
_PIECE = 1 << 17
_rng = np.random.default_rng(20_240_601)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTES_LOWER = _BYTES.copy()
_BYTES_LOWER[65:91] = _BYTES[97:123]
_PLACES = _rng.integers(1, 1 << 63, 5, dtype=np.uint64) | np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
# White space counts for nothing in a sum over bytes.
_BYTES[_IS_SPACE] = _BYTES_LOWER[_IS_SPACE] = 0
_STEP = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
_POWERS = _INVERSES = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers evenly (the finalizer of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64, from 0 to n at least."""
    global _POWERS, _INVERSES
    if n >= len(_POWERS):
        steps = [np.full(2 * n, x, np.uint64) for x in (_STEP, np.uint64(pow(int(_STEP), -1, 1 << 64)))]
        for s in steps:
            s[0] = 1
        with np.errstate(over="ignore"):
            _POWERS, _INVERSES = (np.cumprod(s, dtype=np.uint64) for s in steps)
    return _POWERS, _INVERSES


def _piece_hashes(data: np.ndarray, first: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in some bytes and where they start; `first` marks bytes that begin a text."""
    solid = (data != 32) & (data - np.uint8(9) > 4)
    start = solid.copy()
    start[1:] &= ~solid[:-1] | first[1:]
    at = np.flatnonzero(start)
    if not len(at):
        return np.empty(0, np.uint64), at
    powers, inverses = _powers(len(data))
    with np.errstate(over="ignore"):
        # Bytes count by their place in the piece, up to the next start; the inverse makes that the place in the word.
        sums = np.cumsum((_BYTES_LOWER if lower else _BYTES)[data] * powers[: len(data)])
        return mix(np.diff(sums[at[1:] - 1], prepend=np.uint64(0), append=sums[-1]) * inverses[at]), at


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """`(hashes, bounds)`: one hash per word of the batch; the words of text i are `hashes[bounds[i]:bounds[i + 1]]`.

    Texts are read whole, in pieces of about 128 KB cut at white space, so that the memory beside the words is bounded.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    begins = offsets - low
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    hashes, starts, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + _PIECE)
        while end < len(data) and not (first[end] or _IS_SPACE[data[end]]):
            later = np.flatnonzero(_IS_SPACE[data[end : end + _PIECE]] | first[end : min(end + _PIECE, len(data))])
            end = end + int(later[0]) if len(later) else min(len(data), end + _PIECE)
        found, where = _piece_hashes(data[at:end], first[at:end], lower)
        hashes.append(found)
        starts.append(where + at)
        at = end
    where = np.concatenate(starts) if starts else np.empty(0, np.int64)
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), np.searchsorted(where, begins)


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its `size`-word shingles; a shorter text is one shingle; no word, none."""
    words, bounds = word_hashes(texts)
    with np.errstate(over="ignore"):
        # `size` products of different odd numbers: a shingle's hash depends on the order of its words.
        odd = [np.uint64(_PLACES[i % 5]) + np.uint64(2 * (i // 5)) for i in range(size)]
        whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for i in range(size):
            whole += words[i : i + len(whole)] * odd[i]
        whole = mix(whole)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= size:
                yield np.unique(whole[a : b - size + 1])
            elif b > a:
                short = words[a:b] * np.array(odd[: b - a], np.uint64)
                yield mix(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield np.empty(0, np.uint64)
