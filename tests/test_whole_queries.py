"""Queries at the library's own sizes see the words that the smaller ones cut."""

from __future__ import annotations

import re

import pytest

from precis.plans.queries import QUERIES, talk


def words(text):
    return re.findall("[a-z0-9]+", text.lower())


def test_decode_gives_every_word_back(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["text"] for r in QUERIES["decode_whole_texts"](spark, sf).collect()}
    assert max(len(words(t)) for t in texts.values()) > 1024
    assert got == {k: " ".join(words(t)) for k, t in texts.items()}


@pytest.mark.parametrize("name", ["encode_pairs_at_defaults", "pad_batches_at_defaults", "export_training_data_at_defaults"])
def test_pairs_keep_the_default_lengths(spark, sf, name):
    prefix = 1 if name.startswith("export") else 0
    want = {r["id"]: (len(words(r["text"])) + prefix, len(words(r["summary"]))) for r in talk(spark, sf).collect()}
    assert max(n for n, _ in want.values()) >= 64 and max(n for _, n in want.values()) >= 32
    rows = QUERIES[name](spark, sf).collect()
    assert {r["id"] for r in rows} == set(want)
    for r in rows:
        ids = [[i for i in r[c].split(",") if i not in ("0", "-100")] for c in ("input_ids", "labels")]
        assert [len(i) for i in ids] == [min(n + 1, most) for n, most in zip(want[r["id"]], (1024, 128), strict=True)]
