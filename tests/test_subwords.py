from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from precis.functions.tokens import mask_labels, pad_to_length
from precis.operators import subwords

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
END = 50_256
TEXTS = ["", None, "Hello  world!\n", "a <|endoftext|> b", "日本語 🙂 é", " lead", "x" * 3000, "one two three " * 2000, "\x00 "]


def test_ids_are_those_of_the_library(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row int, text string").repartition(3)
    rows = subwords.encode_subwords(df, PATH, {"whole": ("text", None), "cut": ("text", 5)}, END).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        assert r.whole == [*ids, END] and r.cut == [*ids[:4], END]
    no_end = subwords.encode_subwords(df.filter("row = 2"), PATH, {"ids": ("text", 3)}).first().ids
    assert no_end == plain.encode(TEXTS[2], add_special_tokens=False).ids[:3]


def test_texts_come_back_from_padded_and_masked_ids(spark, monkeypatch):
    monkeypatch.setattr(subwords, "_CHARS_AT_ONCE", 100)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row int, text string").repartition(3)
    ids = subwords.encode_subwords(df, PATH, {"ids": ("text", None)}, END)
    padded = ids.withColumn("ids", mask_labels(pad_to_length(F.col("ids"), 40, END + 1), END + 1))
    got = {r.row: r.ids for r in subwords.decode_subwords(padded, PATH, ["ids"], (END,)).collect()}
    assert got == {i: t or "" for i, t in enumerate(TEXTS)}
    none = spark.createDataFrame([(None,), ([],), ([None, -100],)], "ids array<int>")
    assert sorted(map(str, (r.ids for r in subwords.decode_subwords(none, PATH, ["ids"]).collect()))) == ["", "", "None"]
    assert subwords.encode_subwords(df.limit(0), PATH, {"ids": ("text", None)}).count() == 0


def test_a_batch_of_ids_is_not_held_as_python_numbers(spark):
    """Two million ids there and back: lists of numbers, which took 72 MB and more at once, are made for a portion."""
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["one two three four " * 500] * 1000)
    encode, decode = (made.func for made in (subwords.subword_ids(spark, PATH), subwords.subword_texts(spark, PATH)))
    tracemalloc.start()
    (ids,) = encode(iter([texts]))
    there = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    (back,) = decode(iter([ids]))
    again = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ids.values) > 1_900_000 and back.equals(texts)
    assert max(there, again) < 60_000_000
