"""Token ids of whole texts with the tokenizers library, each distinct word encoded once per task."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MOST_WORDS = 700_000
# White space in UTF-8: by one byte, and what begins with one of four others by two or three.
_WHITE = np.zeros(256, bool)
_WHITE[[*range(9, 14), *range(28, 33)]] = True
_MAYBE = np.zeros(256, bool)
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_WHITE_2 = np.array([0xC285, 0xC2A0])
_WHITE_3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def _piece_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces of texts in UTF-8 begin: with each text, and at each space before a character that is no white space."""
    cut = np.zeros(len(data) + 1, bool)
    # A text's last byte has nothing behind it.
    cut[:-2] = (data[:-1] == 32) & ~_WHITE[data[1:]]
    cut[begins[begins > 0] - 1] = False
    odd = np.flatnonzero(cut[:-2] & _MAYBE[data[1:]])
    if len(odd):
        # A character that begins with such a byte has at least one more; those of two bytes may end the data.
        two = data[odd + 1].astype(np.int64) << 8 | data[odd + 2]
        three = two << 8 | data[np.minimum(odd + 3, len(data) - 1)]
        cut[odd[np.isin(two, _WHITE_2) | np.isin(three, _WHITE_3)]] = False
    cut[begins] = True
    return np.flatnonzero(cut[:-1])


class _Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class Encoder:
    """Ids of texts under a byte-level BPE whose tokens never reach over a space before a word.

    Such a tokenizer cuts a text before every space that a non-space character follows, so a text's ids are those of
    its pieces between these cuts. The library encodes each distinct piece once; the rest is lookups. The table of
    pieces starts anew beyond `_MOST_WORDS`, so memory stays bounded; results do not depend on it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # In a byte-level vocabulary the letter \u0120 stands for a space.
        names = self.tokenizer.get_vocab()
        self.leads = np.zeros(max(names.values()) + 1, bool)
        self.leads[[number for name, number in names.items() if name.startswith("\u0120")]] = True
        self._reset()

    def _reset(self) -> None:
        self.number = _Numbers()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _pieces(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all pieces and how many each text has. They are told apart by batch, each distinct one is looked up once."""
        if len(self.number) > _MOST_WORDS:
            self._reset()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = texts.fill_null("") if texts.null_count else texts
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        low, high = int(offsets[0]), int(offsets[-1])
        if high == low:
            return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[low:high]
        bounds = offsets - low
        starts = _piece_starts(data, bounds[:-1])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        known = np.array([self.number[piece] for piece in coded.dictionary.to_pylist()], np.int64)
        self._learn()
        return known[np.asarray(coded.indices)], np.diff(np.searchsorted(starts, bounds))

    def _learn(self) -> None:
        known = len(self.starts) - 1
        if len(self.number) == known:
            return
        keys = [key.decode() for key in list(self.number)[known:]]
        # Pieces with one space, before them, are encoded as one text, in which a token with a leading space starts a piece.
        joined = np.array([key.startswith(" ") and " " not in key[1:] for key in keys])
        lengths = np.zeros(len(keys), np.int64)
        together = self.tokenizer.encode_batch_fast(["".join([key for key, ok in zip(keys, joined, strict=True) if ok])], add_special_tokens=False)[0].ids
        together = np.array(together, np.uint32)
        starts = np.flatnonzero(self.leads[together])
        lengths[joined] = np.diff(np.append(starts, len(together)))
        alone = [key for key, ok in zip(keys, joined, strict=True) if not ok]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)]
        lengths[~joined] = [len(ids) for ids in found]
        ends = np.cumsum(lengths)
        flat = np.empty(int(ends[-1]), np.uint32)
        inside = np.repeat(joined, lengths)
        flat[inside] = together
        flat[~inside] = [i for ids in found for i in ids]
        self.starts = np.concatenate([self.starts, self.starts[-1] + ends])
        self.ids = np.concatenate([self.ids, flat])

    def lengths(self, texts: pa.Array | list[str | None]) -> np.ndarray:
        numbers, counts = self._pieces(texts)
        total = np.concatenate([[0], np.cumsum(np.diff(self.starts)[numbers])])
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and how many each text has."""
        numbers, counts = self._pieces(texts)
        sizes = np.diff(self.starts)[numbers]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        at += np.arange(total)
        bounds = np.concatenate([[0], ends])
        upto = np.cumsum(counts)
        return self.ids[at], bounds[upto] - bounds[upto - counts]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    return Encoder(path)


def in_portions(texts: pa.Array | list[str | None], most_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `most_chars` characters, a longer text alone."""
    start, chars = 0, 0
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist() if isinstance(texts, pa.Array) else [len(t or "") for t in texts]
    for i, size in enumerate(sizes):
        if i > start and chars + size > most_chars:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(texts):
        yield start, len(texts)
