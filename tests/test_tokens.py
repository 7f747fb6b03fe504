from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from precis.functions import tokens as tok
from precis.operators import batches, vocabulary


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "b a b c", "a b"), (2, "A, b! zz", ""), (3, "", "c"), (4, None, None)]
    return spark.createDataFrame(rows, "id int, text string, summary string")


def test_vocabulary_ids_follow_frequency_then_token(docs):
    got = [tuple(r) for r in vocabulary.build_vocab(docs, "text", 3).orderBy("id").collect()]
    assert got == [("b", 3, 3), ("a", 4, 2), ("c", 5, 1)]


@pytest.mark.parametrize("broadcast", ["-1", "100m"])
def test_encode_and_decode(spark, docs, broadcast):
    """The same rows whether the planner sends the vocabulary or shuffles it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        vocab = vocabulary.build_vocab(docs, "text", 3)
        ids = vocabulary.encode(docs, vocab, {"x": ("text", 4), "y": ("summary", 8)})
        assert ids.columns == [*docs.columns, "x", "y"]
        assert [(r.id, r.x, r.y) for r in ids.orderBy("id").collect()] == [
            (1, [3, 4, 3, 1], [4, 3, 1]),
            (2, [4, 3, 2, 1], [1]),
            (3, [1], [5, 1]),
            (4, [1], [1]),
        ]
        texts = vocabulary.decode(ids, vocab, ["x", "y"], {"x": "n"}).orderBy("id")
        assert [(r.x, r.y, r.n) for r in texts.collect()] == [("b a b", "a b", 4), ("a b", "", 4), ("", "c", 1), ("", "", 1)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("broadcast", ["1", "100m"])
def test_every_row_and_token_counts(spark, broadcast):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        vocab = spark.range(40_000).select(F.concat(F.lit("w"), "id").alias("token"), (F.col("id") + 3).cast("int").alias("id"))
        rows = [(1, "w0 w31999 w32000 w39999"), (1, "w1"), (None, "w2"), (None, "w2"), (2, "zz")]
        ids = vocabulary.encode(spark.createDataFrame(rows, "id int, text string"), vocab, {"ids": ("text", 9)})
        assert sorted((r.id or 0, r.ids) for r in ids.collect()) == [
            (0, [5, 1]), (0, [5, 1]), (1, [3, 32002, 32003, 40002, 1]), (1, [4, 1]), (2, [2, 1])
        ]
        back = vocabulary.decode(ids, vocab, ["ids"])
        assert sorted((r.id or 0, r.ids) for r in back.collect()) == [(0, "w2"), (0, "w2"), (1, rows[0][1]), (1, "w1"), (2, "")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_sentence_ends_survive_ids(spark):
    """So the score per sentence of decoded ids is not that of the whole."""
    from precis.operators import evaluation

    rows = [("Red lens. Blue strap! Good.", "Blue strap. Red lens.")]
    df = spark.createDataFrame(rows, "said string, wanted string").withColumn("split", F.lit("test"))
    both = df.select(F.concat_ws(" ", "said", "wanted").alias("text"))
    vocab = vocabulary.build_vocab(both, "text", 50, tok.sentence_tokens)
    ids = vocabulary.encode(df, vocab, {"prediction_ids": ("said", 50), "labels": ("wanted", 50)}, tok.sentence_tokens)
    back = vocabulary.decode(ids, vocab, ["prediction_ids"]).first().prediction_ids
    assert back == "red lens. blue strap! good."
    metrics = evaluation.evaluate_ids(ids, vocab).first()
    assert metrics.rougeL < metrics.rougeLsum and metrics.samples == 1


def test_vocabulary_cuts_ties_by_name(spark):
    df = spark.createDataFrame([("c c b b a a d e f",)], "text string")
    for size in range(1, 8):
        got = [r.token for r in vocabulary.build_vocab(df, "text", size).orderBy("id").collect()]
        assert got == list("abcdef")[:size]


def test_validation_targets_have_a_limit_of_their_own(docs):
    vocab = vocabulary.build_vocab(docs, "text", 3)
    first = docs.filter("id = 1")

    def labels(**options):
        return vocabulary.encode_pairs(first, vocab, max_target_length=3, **options).first().labels

    assert labels() == [4, 3, 1]
    assert labels(validation=True) == [4, 3, 1]
    assert labels(validation=True, val_max_target_length=2) == [4, 1]
    padded = dict(pad_to_max_length=True, validation=True, val_max_target_length=5)
    assert labels(**padded) == [4, 3, 1, -100, -100]
    assert labels(**padded, ignore_pad_token_for_loss=False) == [4, 3, 1, 0, 0]


def test_array_functions(values):
    ids = [([5, 0, 1],), ([],), ([-100, 7],)]
    assert values(ids, "ids array<int>", tok.pad_to_length(F.col("ids"), 2)) == [[5, 0, 1], [0, 0], [-100, 7]]
    assert values(ids, "ids array<int>", tok.mask_labels(F.col("ids"))) == [[5, -100, 1], [], [-100, 7]]
    assert values(ids, "ids array<int>", tok.unmask_labels(F.col("ids"))) == [[5, 0, 1], [], [0, 7]]
    assert values(ids, "ids array<int>", tok.generated_length(F.col("ids"))) == [2, 0, 1]


def test_batches_are_padded_to_their_longest(spark):
    df = spark.range(1, 41).select(
        "id",
        F.array_repeat(F.lit(9), (F.col("id") % 7 + 1).cast("int")).alias("input_ids"),
        F.array_repeat(F.lit(8), (F.col("id") % 3 + 1).cast("int")).alias("labels"),
    )
    rows = batches.pad_batches(df.repartition(5), "id", batch_size=6, multiple_of=4).collect()
    assert len(rows) == 40
    by_batch = {}
    for r in rows:
        assert sum(i == 9 for i in r.input_ids) == r.id % 7 + 1
        assert sum(i == 8 for i in r.labels) == r.id % 3 + 1
        by_batch.setdefault(r.batch, []).append(r)
    assert {b: sorted(r.id for r in members) for b, members in by_batch.items()} == {b: list(range(6 * b + 1, min(6 * b + 7, 41))) for b in range(7)}
    for members in by_batch.values():
        for width, real in ((len(members[0].input_ids), max(r.id % 7 + 1 for r in members)), (len(members[0].labels), max(r.id % 3 + 1 for r in members))):
            assert width == -(-real // 4) * 4
        assert len({(len(r.input_ids), len(r.labels)) for r in members}) == 1


def test_batches_go_through_null_and_repeated_keys(spark):
    df = spark.range(90).select(
        F.when(F.col("id") % 3 > 0, F.floor(F.col("id") / 9)).alias("key"),
        F.array_repeat(F.col("id").cast("int"), (F.col("id") % 5).cast("int")).alias("input_ids"),
        F.when(F.col("id") % 10 > 0, F.array(F.lit(1))).alias("labels"),
    )
    rows = batches.pad_batches(df.repartition(7), "key", batch_size=8).collect()
    assert len(rows) == 90
    held = {}
    for r in rows:
        held.setdefault(r.batch, []).append(r.key)
    assert [len(held[b]) for b in range(12)] == [8] * 11 + [2]
    in_order = [key for b in range(12) for key in sorted(held[b], key=lambda k: (k is not None, k or 0))]
    assert in_order == [None] * 30 + sorted(k for k in in_order if k is not None)
    assert batches.pad_batches(df.limit(0), "key").collect() == []


ODD_TEXTS = ["a b", "", "c", None, "x1-é日y\nz", "\n", "q ", "Ünï ÇA va", "İKK2", "end", "é", "1" * 300, " one two  three "]


def test_words_cut_by_batch_are_those_of_the_pattern(spark):
    """Every text's words, also at the borders of texts, in slices of a batch, and with the first ones only."""
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, t string")
    rows = df.select("id", F.lower("t").alias("low"), F.coalesce(tok.word_tokens(F.col("t")), F.array().cast("array<string>")).alias("w")).orderBy("id").collect()
    low, want = pa.array([r["low"] for r in rows], pa.string()), [r["w"] for r in rows]
    for most in (None, 0, 1, 2, 100):
        assert tok.lowered_words(low, most).to_pylist() == [w[:most] for w in want]
        assert tok.lowered_words(low.slice(2, 6), most).to_pylist() == [w[:most] for w in want[2:8]]
    assert tok.lowered_words(pa.array([], pa.string())).to_pylist() == []


def test_plain_words_are_counted_and_encoded_by_batch(spark, capsys):
    """No pattern is matched and no row made for each word; counts and ids are those of the pattern."""
    df = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "id int, t string")
    plain = lambda col: tok.word_tokens(col)  # noqa: E731  another tokenizer, as far as the operators know
    counts = vocabulary.count_tokens(df, "t")
    counts.explain()
    plan = capsys.readouterr().out
    assert "MapInArrow" in plan and "regexp_extract_all" not in plan
    assert sorted(counts.collect()) == sorted(vocabulary.count_tokens(df, "t", plain).collect())
    vocab = vocabulary.build_vocab(df, "t", 6)
    for length in (1, 2, 50):
        made, same = (vocabulary.encode(df, vocab, {"ids": ("t", length)}, tokenize, keep=["id"]) for tokenize in (tok.word_tokens, plain))
        assert sorted(made.collect()) == sorted(same.collect())
