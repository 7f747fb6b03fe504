from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from precis.llm import alignment
from precis.llm.queries import piece_tokenizer_path, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    """Both libraries on the whole text: `(a_ids, a_bytes, b_ids, b_bytes)`."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    names = {v: k for k, v in a.get_vocab().items()}
    letters = alignment.byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=piece_tokenizer_path())

    def run(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        others = b.encode(text)
        as_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in others)]
        return ids, [bytes(letters[c] for c in names[i]) for i in ids], others, as_bytes

    return run


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return [(e - len(p), e) for p, e in zip(parts, ends, strict=True)]


def brute(plain, rows):
    """The contract by definition, a text at a time."""
    found, docs = [], Counter()
    for key, text in rows:
        a, b, links, groups = [], [], [], []
        if text:
            ids, a_bytes, others, b_bytes = plain(text)
            if b"".join(a_bytes) == b"".join(b_bytes) == b" " + text.encode():
                a, b = ids, others
                sa, sb = spans(a_bytes), spans(b_bytes)
                links = [(i, j) for i, (s, e) in enumerate(sa) for j, (t, f) in enumerate(sb) if s < f and t < e]
                both = sorted({e for _, e in sa} & {e for _, e in sb})
                low = 0
                for end in both:
                    ga = [str(a[i]) for i, (s, e) in enumerate(sa) if s >= low and e <= end]
                    gb = [str(b[i]) for i, (s, e) in enumerate(sb) if s >= low and e <= end]
                    groups.append(",".join(ga) + "|" + ",".join(gb))
                    low = end
        pairs = [(a[i], b[j]) for i, j in links]
        docs.update(set(pairs))
        found.append((key, a, b, groups, pairs))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return [
        (key, len(a), len(b), len(g), len(p), sum(docs[x] == best[x[0]] for x in p), sum(docs[x] for x in p), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for key, a, b, g, p in found
    ]


ODD = ["", None, " ", "  ", " a", "a ", "a  b", "a \n b\n\n  c\t d", "x<|endoftext|> y", "<s> </s>", "a\xa0 b 　c", "\x1c \x1c a", " \x85 b", "日本 語 。éé", "_▁_",
       "Ġ ĠĠ a", "﻿ b", "it's  'll we'll", "a\x00b", "🙂🙂 🙂", "ﬁ ́e", "12345 67 8.9", "▁", "▁ a b", "a b", "a b", "\r\n \r\n x"]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in r))


def test_equals_the_definition(spark, plain, corpus):
    rows = [(r[0], r[1]) for r in corpus if not r[1] or len(r[1]) < 3000] + [(100 + i, t) for i, t in enumerate(ODD)] + [(None, "a b")]
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], "doc_id long, text string, block string, keys int, place int").repartition(3)
    got = [tuple(r) for r in alignment.align_corpus(df, tokenizer_path(), piece_tokenizer_path()).collect()]
    assert order(got) == order(brute(plain, rows))


def test_whole_texts_of_the_tables(spark, sf, plain):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    codes = alignment.Pair(alignment.byte_level_side(tokenizer_path()), alignment.piece_side(piece_tokenizer_path()))
    a_ids, b_ids, n_a, n_b = codes.tokens([t for _, t in rows])
    a_at, b_at = np.cumsum(n_a), np.cumsum(n_b)
    for i, (_, text) in enumerate(rows):
        ids, _, others, _ = plain(text or "")
        assert a_ids[a_at[i] - n_a[i] : a_at[i]].tolist() == (ids if text else [])
        assert b_ids[b_at[i] - n_b[i] : b_at[i]].tolist() == others


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab 's\n\t\xa0é🙂1.　"), max_size=24))
def test_pieces_give_the_ids_of_the_whole_text(plain, text):
    codes = alignment.pair(tokenizer_path(), piece_tokenizer_path())
    a_ids, b_ids, *_ = codes.tokens([text])
    ids, _, others, _ = plain(text)
    assert (a_ids.tolist(), b_ids.tolist()) == ((ids, others) if text else ([], []))


def test_groups_put_together_are_the_text(spark, plain):
    rows = [(i, t) for i, t in enumerate([*ODD, "some words, and others"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in alignment.groups(df, tokenizer_path(), piece_tokenizer_path()).collect():
        ids, _, others, b_bytes = plain(rows[r["_key"]][1] or "")
        ok = rows[r["_key"]][1] and b"".join(b_bytes) == b" " + rows[r["_key"]][1].encode()
        assert (r["a_ids"], r["b_ids"]) == ((ids, others) if ok else ([], []))
        assert (sum(r["a_per_group"]), sum(r["b_per_group"])) == (len(r["a_ids"]), len(r["b_ids"]))
        assert sum(r["group_bytes"]) == (len((" " + rows[r["_key"]][1]).encode()) if ok else 0)


def test_no_rows_and_a_table_that_starts_anew(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.align_corpus(none, tokenizer_path(), piece_tokenizer_path()).collect() == []
    codes = alignment.Pair(alignment.byte_level_side(tokenizer_path()), alignment.piece_side(piece_tokenizer_path()))
    before = codes.tokens(["a b c", "x  y"])
    codes.chars = 1 << 40
    after = codes.tokens(["a b c", "x  y"])
    assert all((p == q).all() for p, q in zip(before, after, strict=True))
