"""Alignment of two tokenizers over the same bytes.

Tokens are byte intervals. All tokens of both sides are sorted by start; where a start reaches the largest end so far, both
sides have a boundary and a group ends. Inside a group every pair of tokens whose intervals overlap is a link.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from precis.llm.common import saved
from precis.llm.tokenizing import in_portions

# A cut before a single space that follows anything but a space and precedes anything but white space.
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")
_NOT_PLAIN = re.compile(r" \s|\A | \Z")
_MOST_PIECES, _MOST_CHARS = 200_000, 8_000_000
# Characters of a block of texts; a dozen arrays with an entry per token are in memory for it.
_BLOCK_CHARS = 1_000_000
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>\Z")
_SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _Numbers(dict):
    """Gives each new key the next number."""

    def __missing__(self, key):
        number = self[key] = len(self)
        return number


@dataclass
class Side:
    """One tokenizer: ids of pieces of text, each with a space before it, and the bytes of each id."""

    encode: object
    tokens: list[bytes]

    def __post_init__(self):
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.reset()

    def reset(self) -> None:
        self.ids = np.empty(0, np.int64)
        self.starts = np.zeros(1, np.int64)

    def learn(self, pieces: list[str]) -> np.ndarray:
        """Adds the pieces; which of them come back from their tokens' bytes."""
        found = self.encode(pieces)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(i) for i in found], dtype=np.int64)])
        self.ids = np.concatenate([self.ids, np.array([i for ids in found for i in ids], np.int64)])
        tokens = self.tokens
        return np.array([b"".join([tokens[i] for i in ids]) == b" " + piece.encode() for ids, piece in zip(found, pieces, strict=True)], bool)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of pieces, and how many each piece has."""
        sizes = np.diff(self.starts)[numbers]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        return self.ids[at + np.arange(len(at))], sizes


def byte_level_side(path: str) -> Side:
    """A byte-level BPE of the tokenizers library; strings of special tokens in a text are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark spreads the work
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters, names = byte_letters(), tokenizer.get_vocab()
    tokens = [b""] * (max(names.values()) + 1)
    for name, number in names.items():
        tokens[number] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
    return Side(lambda pieces: [e.ids for e in tokenizer.encode_batch_fast([" " + p for p in pieces], add_special_tokens=False)], tokens)


def piece_side(path: str) -> Side:
    """A sentencepiece model that adds a space before the text; its pieces may hold a space only where they begin."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    if any(_SPACE in name.lstrip(_SPACE) for name in names):
        raise ValueError("pieces reach over a space, so texts can't be cut before words")
    code = [_BYTE_PIECE.match(name) if model.is_byte(i) else None for i, name in enumerate(names)]
    tokens = [bytes([int(c[1], 16)]) if c else name.replace(_SPACE, " ").encode() for c, name in zip(code, names, strict=True)]
    return Side(lambda pieces: model.encode(pieces, num_threads=1), tokens)


class Pair:
    """Both tokenizers over batches of texts. A text is cut before words, where neither has a token that reaches over the
    cut; each distinct piece is encoded once. The table of pieces starts anew when it is large, so memory is bounded."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self._reset()

    def _reset(self) -> None:
        self.number = _Numbers()
        self.known = self.chars = 0
        self.good = np.empty(0, bool)
        self.a.reset()
        self.b.reset()

    def _learn(self) -> None:
        new = list(self.number)[self.known :]
        if new:
            self.chars += sum(map(len, new))
            self.known += len(new)
            self.good = np.concatenate([self.good, self.a.learn(new) & self.b.learn(new)])

    def tokens(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B for all texts with a space before each, and how many of each a text has.

        Texts that are null, empty, or don't come back from the tokens' bytes have none.
        """
        if len(self.number) > _MOST_PIECES or self.chars > _MOST_CHARS:
            self._reset()
        find, numbers, counts = self.number.__getitem__, [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                parts = _CUT.split(text) if _NOT_PLAIN.search(text) else text.split(" ")
                counts[i] = len(parts)
                numbers.extend(map(find, parts))
        self._learn()
        pieces = np.array(numbers, np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        bad = np.bincount(owner, ~self.good[pieces], len(texts)) > 0
        pieces, owner = pieces[~bad[owner]], owner[~bad[owner]]
        out = []
        for side in (self.a, self.b):
            ids, sizes = side.of(pieces)
            out += [ids, np.bincount(owner, sizes, len(texts)).astype(np.int64)]
        return out[0], out[2], out[1], out[3]


@lru_cache(maxsize=1)
def pair(a_path: str, b_path: str) -> Pair:
    """The worker's tokenizers, kept from task to task."""
    return Pair(byte_level_side(a_path), piece_side(b_path))


def coalesce(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of every A and of every B interval, numbered from 0 in order; each side sorted, none of length 0."""
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    side = np.repeat(np.array([0, 1], np.int8), [len(a_starts), len(b_starts)])
    order = np.lexsort((side, starts))
    furthest = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= furthest[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a_starts)], group[len(a_starts) :]


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of A and B of all pairs of intervals that share a byte; each side sorted and without overlaps of its own."""
    first = np.searchsorted(b_ends, a_starts, "right")
    count = np.searchsorted(b_starts, a_ends, "left") - first
    a = np.repeat(np.arange(len(a_starts)), count)
    b = np.arange(len(a)) + np.repeat(first - (np.cumsum(count) - count), count)
    return a, b


def _digits(size: int) -> tuple[np.ndarray, np.ndarray]:
    """How many decimal digits each number below `size` has, and the digits as characters, the last one first."""
    numbers = np.arange(max(size, 1))
    places = len(str(max(size - 1, 1)))
    table = np.stack([48 + numbers // 10**d % 10 for d in range(places)]).astype(np.uint8)
    return 1 + sum(numbers >= 10**d for d in range(1, places)), table


class Written:
    """Groups in writing: ids of A by commas, a bar, ids of B by commas; groups parted by semicolons."""

    def __init__(self, a_size: int, b_size: int):
        self.a, self.b = _digits(a_size), _digits(b_size)

    def __call__(self, a_ids: np.ndarray, b_ids: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All groups one after the other, a semicolon after each, and where each A token begins."""
        a_width, b_width = self.a[0][a_ids] + 1, self.b[0][b_ids] + 1
        a_upto, b_upto = np.concatenate([[0], np.cumsum(a_width)]), np.concatenate([[0], np.cumsum(b_width)])
        # What stands before a token: its own side's tokens, and the other side's of earlier groups or, for B, up to its own.
        a_at = a_upto[:-1] + b_upto[np.searchsorted(b_group, a_group, "left")]
        b_at = b_upto[:-1] + a_upto[np.searchsorted(a_group, b_group, "right")]
        out = np.empty(int(a_upto[-1] + b_upto[-1]), np.uint8)
        for ids, at, width, group, (_, table), last in ((a_ids, a_at, a_width, a_group, self.a, "|"), (b_ids, b_at, b_width, b_group, self.b, ";")):
            end = at + width - 1
            final = np.ones(len(ids), bool)
            final[:-1] = group[1:] != group[:-1]
            out[end] = np.where(final, ord(last), ord(","))
            for d in range(len(table)):
                has = np.flatnonzero(width - 1 > d) if d else slice(None)
                out[end[has] - 1 - d] = table[d][ids[has]]
        return out, a_at


@dataclass
class Aligned:
    """A batch of texts aligned; groups are numbered through the batch, links in order of their A token."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    a_ends: np.ndarray  # in bytes through the batch
    a_group: np.ndarray
    b_group: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(codes: Pair, texts: list[str | None]) -> Aligned:
    """Texts lie one after the other in bytes, so no group reaches from one into the next."""
    a_ids, b_ids, n_a, n_b = codes.tokens(texts)
    a_ends, b_ends = np.cumsum(codes.a.sizes[a_ids]), np.cumsum(codes.b.sizes[b_ids])
    a_starts, b_starts = a_ends - codes.a.sizes[a_ids], b_ends - codes.b.sizes[b_ids]
    a_group, b_group = coalesce(a_starts, a_ends, b_starts, b_ends)
    return Aligned(a_ids, b_ids, n_a, n_b, a_ends, a_group, b_group, *overlaps(a_starts, a_ends, b_starts, b_ends))


def _own(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))


def groups(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(_key, a_ids, b_ids, a_per_group, b_per_group, group_bytes)`: each text's tokens and how the groups cut them.

    Sizes are per group, in order; bytes count the space before the text. Texts without tokens (null, empty, or not the
    bytes of their tokens) have empty arrays. Rows are answered one by one, whatever their keys.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = pair(a_path, b_path)
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for low, high in in_portions(texts, _BLOCK_CHARS):
                x = align(codes, texts[low:high])
                n = int(x.a_group[-1]) + 1 if len(x.a_group) else 0
                a_in, b_in = np.bincount(x.a_group, minlength=n), np.bincount(x.b_group, minlength=n)
                bytes_to = x.a_ends[np.cumsum(a_in) - 1] if n else np.empty(0, np.int64)
                a_to, b_to = np.cumsum(x.n_a), np.cumsum(x.n_b)
                groups_to = np.searchsorted(np.cumsum(a_in), a_to, "right")
                arrays = [(x.a_ids, a_to), (x.b_ids, b_to), (a_in, groups_to), (b_in, groups_to), (np.diff(bytes_to, prepend=0), groups_to)]
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], to]), pa.int32()), pa.array(flat, pa.int32())) for flat, to in arrays]
                yield pa.RecordBatch.from_arrays([batch.column("_key").slice(low, high - low), *lists], names=["_key", "a_ids", "b_ids", "a_per_group", "b_per_group", "group_bytes"])

    own = _own(docs, key, text)
    kind = own.schema["_key"].dataType.simpleString()
    return own.mapInArrow(cut, f"_key {kind}, a_ids array<int>, b_ids array<int>, a_per_group array<int>, b_per_group array<int>, group_bytes array<int>")


def _blocks(docs: DataFrame, a_path: str, b_path: str, key: str, text: str) -> DataFrame:
    """Two kinds of rows per block of texts (about a million characters, or one longer text), stored once.

    One row holds the texts' keys and figures and, in order of id pair and text, how often each text holds each of its
    linked pairs. The others are the block's distinct pairs with the number of its texts that hold them: what the corpus
    counts are made of, and what asks for them.
    """
    own = _own(docs, key, text)
    kind = own.schema["_key"]
    fields = {"block": pa.string(), "place": pa.int32(), "a": pa.int32(), "b": pa.int32(), "n_docs": pa.int32()}
    per_text = ["n_a", "n_b", "n_groups", "n_links"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, part, number = pair(a_path, b_path), TaskContext.get().partitionId(), 0
        write = Written(len(codes.a.tokens), len(codes.b.tokens))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for low, high in in_portions(texts, _BLOCK_CHARS):
                x = align(codes, texts[low:high])
                name = f"{part}-{number}"
                number += 1
                rows = high - low
                a_to = np.cumsum(x.n_a)
                owner = np.repeat(np.arange(rows), x.n_a)
                first = np.ones(len(x.a_group), bool)
                first[1:] = x.a_group[1:] != x.a_group[:-1]
                n_groups, n_links = np.bincount(owner[first], minlength=rows), np.bincount(owner[x.link_a], minlength=rows)
                said, at = write(x.a_ids, x.b_ids, x.a_group, x.b_group)
                begins = np.append(at, len(said))
                digests = [hashlib.sha256(said[begins[t - n] : begins[t] - 1]).hexdigest() if n else "" for n, t in zip(x.n_a.tolist(), a_to.tolist(), strict=True)]
                # Equal pairs side by side, texts in order among them.
                code = x.a_ids[x.link_a] * len(codes.b.tokens) + x.b_ids[x.link_b]
                order = np.argsort(code, kind="stable")
                code, doc = code[order], owner[x.link_a][order]
                new_code = np.ones(len(code), bool)
                new_code[1:] = code[1:] != code[:-1]
                new = new_code.copy()
                new[1:] |= doc[1:] != doc[:-1]
                starts = np.flatnonzero(new)
                held = np.diff(np.append(starts, len(code)))
                pairs = code[new_code]
                n_docs = np.diff(np.append(np.flatnonzero(new_code[starts]), len(starts)))
                n = len(pairs)
                nothing = [pa.nulls(n, t) for t in (pa.list_(batch.schema.field("_key").type), *[pa.list_(pa.int32())] * 4, pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(n), pa.int32()), pa.array(pairs // len(codes.b.tokens), pa.int32()), pa.array(pairs % len(codes.b.tokens), pa.int32()), pa.array(n_docs, pa.int32()), *nothing], names=names)
                whole = [batch.column("_key").slice(low, rows), *(pa.array(v, pa.int32()) for v in (x.n_a, x.n_b, n_groups, n_links)), pa.array(digests, pa.string()), pa.array(doc[starts], pa.int32()), pa.array(held, pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array([name]), *(pa.nulls(1, t) for t in list(fields.values())[1:]), *(pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in whole)], names=names)

    names = [*fields, "keys", *per_text, "digests", "docs", "held"]
    schema = f"block string, place int, a int, b int, n_docs int, keys array<{kind.dataType.simpleString()}>, n_a array<int>, n_b array<int>, n_groups array<int>, n_links array<int>, digests array<string>, docs array<int>, held array<int>"
    return own.mapInArrow(encode, schema)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """`(a, b, n, best)`: how many texts hold the linked id pair, and whether no pair of its A id is in more."""
    counts = blocks.filter("place is not null").groupBy("a", "b").agg(F.sum("n_docs").alias("n"))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def align_corpus(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(_key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)` per row of `docs`.

    A link's count is the number of rows that hold its id pair linked, corpus-wide; `count_sum` adds it up over a row's
    links, `n_best` counts the links with the highest count of their A id, ties included. `groups_sha256` digests the
    groups as `a1,a2|b1;a3|b2,b3`. Texts that are null, empty or not the bytes of their tokens give zeros and ''. Keys may be
    null or repeat, each row is answered for itself; other columns are not looked at; an empty table gives no rows.

    Texts are read once and never shuffled. Each block of texts sends its distinct pairs to be counted and gets its
    counts back as one array in order, so the join holds a row per block and distinct pair rather than one per link. A
    text must fit a task's memory.
    """
    blocks = saved(_blocks(docs, a_path, b_path, key, text), "aligned-blocks")
    counts = pair_counts(blocks)
    asked = blocks.filter("place is not null").select("block", "place", "a", "b")
    answers = asked.join(counts, ["a", "b"]).groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("answers"))
    answers = answers.select("block", F.col("answers.n").alias("counts"), F.col("answers.best").alias("bests"))
    whole = blocks.filter("place is null").select("block", "keys", "n_a", "n_b", "n_groups", "n_links", "digests", "docs", "held")
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    sizes = blocks.filter("place is not null").select("block", "place", "n_docs").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "n_docs"))).alias("sizes"))
    both = whole.join(answers, "block", "left").join(sizes.select("block", F.col("sizes.n_docs").alias("sizes")), "block", "left").drop("block")

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                column = lambda name: batch.column(name).slice(row, 1).flatten()  # noqa: B023, E731
                keys = column("keys")
                counts, bests, sizes, doc, held = (np.asarray(column(c)).astype(np.int64) for c in ("counts", "bests", "sizes", "docs", "held"))
                which = np.repeat(np.arange(len(sizes)), sizes)
                # Whole numbers: sums of doubles would end at 2^53.
                n_best, count_sum = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
                if len(doc):
                    np.add.at(n_best, doc, held * bests[which])
                    np.add.at(count_sum, doc, held * counts[which])
                longs = [column(c).cast(pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([keys, *longs, pa.array(n_best), pa.array(count_sum), column("digests")], names=out)

    out = ["_key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return both.mapInArrow(rate, f"_key {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")
