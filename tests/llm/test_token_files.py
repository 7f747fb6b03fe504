from __future__ import annotations

import zlib

import numpy as np
import pytest

from precis.llm import coder, token_counts, token_files
from precis.llm.queries import tokenizer_path
from precis.llm.tokenizing import Encoder, in_portions


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["", None, " ", "  ", " a", "a ", "a  b", "a \n b\n\n  c\t d", "x<|endoftext|> y", "a  b 　c", "it's  'll we'll",
       "\x1c \x1c a", "<|endoftext|>", " \u0085 b", "é\n\n\n", "日本 語 。", "a  b", "Ġ ĠĠ a", "﻿ b"]


def test_pieces_give_the_ids_of_the_whole_text(tokenizer, corpus):
    texts = [*ODD, *(t for _, t, *_ in corpus)]
    codes = Encoder(tokenizer_path())
    for _ in range(2):  # new pieces, then known ones
        ids, counts = codes.encode(texts)
        ends = np.cumsum(counts)
        for text, n, e in zip(texts, counts, ends, strict=True):
            assert ids[e - n : e].tolist() == ids_of(tokenizer, text)
        assert codes.lengths(texts).tolist() == counts.tolist()
    codes.number.update({("x", i): 0 for i in range(700_001)})  # the table starts anew
    assert codes.lengths(ODD).tolist() == [len(ids_of(tokenizer, t)) for t in ODD]


def test_portions_cover_all_texts():
    texts = ["a" * n for n in (5, 50, 1, 0, 7, 200, 3)] + [None]
    runs = list(in_portions(texts, 50))
    assert [i for a, b in runs for i in range(a, b)] == list(range(len(texts)))


@pytest.mark.parametrize("shape", [(1, 1), (3, 7), (40, 300), (5, 2048)])
@pytest.mark.parametrize("high", [1, 3, 300, 65_536])
def test_blocks_round_trip(shape, high):
    ids = np.random.default_rng(shape[1] + high).integers(0, high, shape)
    blocks = coder.encode_blocks(ids)
    assert (coder.decode_blocks(blocks, shape[1]) == ids).all()
    # A block is the same, and can be read, without the others.
    assert coder.encode_blocks(ids[-1:])[0] == blocks[-1]


def test_predictable_ids_take_little_room():
    rng = np.random.default_rng(1)
    again = np.tile(rng.integers(0, 50_000, 64), (4, 32))
    assert sum(map(len, coder.encode_blocks(again))) < again.size * 2 / 8


def test_segments_are_checked():
    ids = np.random.default_rng(2).integers(0, 50_000, 5000)
    data = token_files.pack(ids)
    assert (token_files.unpack(data) == ids).all()
    assert len(token_files.unpack(token_files.pack(np.empty(0, np.int64)))) == 0
    broken = bytearray(data)
    broken[-700] ^= 1
    with pytest.raises(ValueError):
        token_files.unpack(bytes(broken))
    for odd in (-1, 1 << 32):
        with pytest.raises(ValueError):
            token_files.pack(np.array([odd]))


@pytest.mark.parametrize("bits", [16, 17, 18, 27, 28, 29, 32])
def test_ids_of_up_to_32_bits(bits):
    rng = np.random.default_rng(bits)
    known = rng.integers(0, 1 << bits, 300)
    ids = np.concatenate([[0, (1 << bits) - 1], rng.choice(known, 3000), rng.integers(0, 1 << bits, 2500)])
    data = token_files.pack(ids)
    assert (token_files.unpack(data) == ids).all()


def test_ids_that_come_again_without_order_take_less_room():
    """Order 0: no id is foretold by those before it, but half of them have come in the block already."""
    rng = np.random.default_rng(5)
    few = rng.integers(0, 1 << 16, (16, 40))
    ids = np.take_along_axis(few, rng.integers(0, 40, (16, coder.BLOCK)), axis=1)
    out = coder.encode_blocks(ids)
    assert (coder.decode_blocks(out, coder.BLOCK) == ids).all()
    assert sum(map(len, out)) / ids.size < 0.95


def test_files_hold_all_ids_in_order(spark, tokenizer, documents, corpus, no_documents, tmp_path):
    token_files.write(documents, f"{tmp_path}/ids", tokenizer_path())
    index = sorted(token_files.read_index(spark, f"{tmp_path}/ids").collect(), key=lambda r: r["start"])
    rows = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["key"] for r in index] == [r[0] for r in rows]
    start = 0
    for got, (_, text, *_) in zip(index, rows, strict=True):
        ids = [*ids_of(tokenizer, text), 0]
        assert (got["start"], got["n_tokens"]) == (start, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    back = {r["key"]: r["ids"] for r in token_files.read(spark, f"{tmp_path}/ids").collect()}
    assert back[28] == [*ids_of(tokenizer, corpus[16][1]), 0]
    token_files.write(no_documents, f"{tmp_path}/none", tokenizer_path())
    assert token_files.read_index(spark, f"{tmp_path}/none").count() == 0


def test_counts_answer_for_every_limit(spark, tokenizer, documents, corpus, no_documents):
    lengths = sorted(len(ids_of(tokenizer, t)) for _, t, *_ in corpus)
    histogram = token_counts.length_histogram(documents, tokenizer_path())
    rows = token_counts.answers(histogram).collect()
    assert {r["n_tokens"]: r["docs"] for r in rows} == {n: lengths.count(n) for n in lengths}
    for r in rows:
        limit = r["n_tokens"]
        assert r["docs_longer"] == sum(n > limit for n in lengths) and r["docs_up_to"] == sum(n <= limit for n in lengths)
        assert r["total_tokens"] == sum(lengths) and r["truncated_total"] == sum(min(n, limit) for n in lengths)
        assert r["lost_tokens"] == r["total_tokens"] - r["truncated_total"]
    cut = {r["context_limit"]: r for r in token_counts.at_limits(histogram, [0, 100, 10**6]).collect()}
    for limit, r in cut.items():
        assert r["truncated_total"] == sum(min(n, limit) for n in lengths) and r["docs_cut"] == sum(n > limit for n in lengths)
    for r in token_counts.quantiles(histogram, [0.25, 0.5, 1.0]).collect():
        assert r["n_tokens"] == min(n for n in lengths if sum(m <= n for m in lengths) >= r["share"] * len(lengths))
    assert token_counts.answers(token_counts.length_histogram(no_documents, tokenizer_path())).count() == 0
