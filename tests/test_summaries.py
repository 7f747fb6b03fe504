from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from precis.operators import extractive, models
from precis.plans import flows
from precis.streaming import summaries as streaming


def test_word_stats(spark):
    df = spark.createDataFrame([("A a b",), ("a",)], "text string")
    got = {r.token: (r["count"], r.p) for r in extractive.fit_word_stats(df, "text").collect()}
    assert got == {"a": (3, 0.75), "b": (1, 0.25)}


def by_hand(texts, counts, min_tokens, max_tokens):
    """The best sentences of texts whose sentences all end in a full stop and a space."""
    sentences = [s for text in texts for s in (text.replace(". ", ".\n").split("\n")) if s]
    def score(s):
        found = s.lower().replace(".", "").split()
        return sum(counts[w] for w in found) / len(found) if found else 0
    ranked = sorted(range(len(sentences)), key=lambda i: (-score(sentences[i]), i))
    kept, used = {}, 0
    for i in ranked:
        if used >= min(min_tokens, max_tokens):
            break
        words = sentences[i].split(" ")
        kept[i] = " ".join(words[: max_tokens - used])
        used += len(words)
    return " ".join(kept[i] for i in sorted(kept))


@pytest.mark.parametrize("hint", ["broadcast", "shuffle_merge"])
@pytest.mark.parametrize("limits", [(5, 8), (2, 3), (100, 200)])
def test_extractive_by_hand(spark, hint, limits):
    """Also with the words' counts joined by a shuffle."""
    rows = [(g, i, f"w{i % 5} w{(i + g) % 3}. Tail w{i} x{g}. w1 w1") for g in range(4) for i in range(6 + 10 * (g == 2))]
    df = spark.createDataFrame(rows, "grp int, row int, text string").repartition(5)
    stats = extractive.fit_word_stats(df, "text").hint(hint)
    counts = Counter(w for _, _, t in rows for w in t.lower().replace(".", "").split())
    groups = defaultdict(list)
    for g, _, t in rows:
        groups[g].append(t)
    got = extractive.summarize_extractive(df, stats, "grp", "text", "row", *limits).collect()
    assert {r.grp: r.summary for r in got} == {g: by_hand(t, counts, *limits) for g, t in groups.items()}
    single = extractive.add_summaries(df, stats, "text", "best", *limits).collect()
    assert len(single) == len(rows)
    assert all(r.best == by_hand([r.text], counts, *limits) for r in single)


def test_every_row_has_a_summary(spark):
    rows = [(1, "One two. One."), (1, None), (None, ""), (None, " \n "), (2, "?"), (2, "?")]
    df = spark.createDataFrame(rows, "key int, text string")
    stats = extractive.fit_word_stats(df, "text")
    got = extractive.summarize_extractive(df, stats, "key", "text").collect()
    assert sorted((r.key or 0, r.summary) for r in got) == [(0, ""), (0, ""), (1, ""), (1, "One two. One."), (2, "?"), (2, "?")]


def test_texts_of_equal_order_stay_apart(spark):
    rows = [("g", 1, "Red lens."), ("g", 1, "Blue lens."), ("g", None, "Old lens."), ("h", 1, None)]
    df = spark.createDataFrame(rows, "key string, row int, text string")
    stats = extractive.fit_word_stats(df, "text")
    got = {r.key: r.summary for r in extractive.summarize_extractive(df, stats, "key", "text", "row").collect()}
    assert sorted(got["g"].split(". ")) == sorted(["Old lens", *got["g"].split(". ")[1:]]) and len(got["g"].split()) == 6


def test_model_gets_prefixed_batches_and_nulls_stay_null(spark):
    def model(texts):
        assert 0 < len(texts) <= 3
        assert all(t.startswith("summarize: ") for t in texts)
        return [t[-2:].upper() for t in texts]

    df = spark.range(20).select("id", F.when(F.col("id") != 4, F.concat(F.lit("text "), F.col("id") + 10)).alias("text"))
    got = {r.id: r.summary for r in models.summarize(df, "text", model, batch_size=3).collect()}
    assert got == {i: None if i == 4 else str(i + 10) for i in range(20)}


def test_model_input_can_be_cut(spark):
    df = spark.createDataFrame([("a b c d",)], "text string")
    out = models.summarize(df, "text", lambda texts: texts, prefix=None, max_tokens=2)
    assert out.first().summary == "a b"


def test_map_batches_may_drop_rows_and_change_columns(spark):
    def long_ones(batch):
        return batch[batch["id"] > 6].assign(double=lambda b: b["id"] * 2)[["double"]]

    got = models.map_batches(spark.range(10), long_ones, "double bigint").collect()
    assert sorted(r.double for r in got) == [14, 16, 18]


def test_group_summaries_reach_every_part(spark):
    rows = [("a" if i % 3 else "hot", i, f"Good lens number {i}. Fine.") for i in range(60)]
    df = spark.createDataFrame(rows, "key string, row int, text string")
    stats = extractive.fit_word_stats(df, "text")
    whole = flows.summaries_by_group(df, stats, "key", "text", "row").collect()
    parts = flows.summaries_by_group(df, stats, "key", "text", "row", max_part_chars=200).collect()
    summary = {r.key: r.summary for r in whole}
    assert len(whole) == 2 and len(parts) > 4
    assert all(r.summary == summary[r.key] for r in parts)
    assert sorted(w for r in whole for w in r.reviews.split()) == sorted(w for r in parts for w in r.reviews.split())


def test_group_summaries_by_model(spark):
    df = spark.createDataFrame([("a", i, f"text {i}") for i in range(12)], "key string, row int, text string")
    out = flows.model_summaries_by_group(df, lambda texts: [str(len(t.split())) for t in texts], "key", "text", "row", max_tokens=6)
    # The model was given three texts; the group's text is whole.
    assert tuple(out.first()) == ("a", 0, 12, " ".join(f"text {i}" for i in range(12)), "7")


def test_train_evaluate_predict(spark, tmp_path):
    rows = [(i, s, f"Common words here. Odd{i} thing{i}.", "common words") for i, s in enumerate(["train"] * 6 + ["validation"] * 3 + ["test"] * 4)]
    rows.append((99, "test", "dropped", None))
    data = spark.createDataFrame(rows, "row int, split string, body string, headline string")
    paths = flows.train_evaluate_predict(data, str(tmp_path), "row", max_samples={"test": 3})
    metrics = {r.split: r for r in spark.read.json(paths["metrics"]).collect()}
    assert metrics["validation"].samples == 3 and metrics["test"].samples == 3 and metrics["train"].samples == 6
    with pytest.raises(ValueError, match="no rows of split 'train'"):
        flows.train_evaluate_predict(data.filter("split <> 'train'"), str(tmp_path / "none"), "row")
    assert math.isclose(metrics["test"].rouge1, 57.1429)
    lines = [r.value for r in spark.read.text(paths["predictions"]).collect()]
    assert lines == [f"Common words here. Odd{i} thing{i}." for i in (9, 10, 11)]


def test_training_data_is_exported_per_split(spark, tmp_path):
    rows = [(i, "train" if i < 10 else "validation", f"a b c{i}", "a") for i in range(14)] + [(20, "train", "x", None)]
    data = spark.createDataFrame(rows, "row int, split string, text string, summary string")
    paths = flows.export_training_data(data, str(tmp_path), "row", max_source_length=4, batch_size=4, max_samples={"train": 8})
    vocab = {r.token: r.id for r in spark.read.parquet(paths["vocab"]).collect()}
    got = {r.row: r for r in spark.read.parquet(paths["batches"]).collect()}
    assert sorted(got) == [*range(8), *range(10, 14)] and got[10].split == "validation"
    assert all(r.input_ids == [vocab["summarize"], vocab["a"], vocab["b"], 1] and r.labels == [vocab["a"], 1] for r in got.values())
    assert {r.batch for r in got.values() if r.split == "train"} == {0, 1}


def test_from_raw_files_to_group_summaries(spark, tmp_path):
    """The flows one after the other, on columns with awkward names."""
    lines = [f"{i}\t{'hot' if i % 3 else 'p' + str(i % 4)}\tHead {i}\tGood <b>lens</b> {i}. Rest.\n" for i in range(120)]
    (tmp_path / "raw.tsv").write_text("at\tproduct_id\treview_headline\treview_body\n" + "".join(lines))
    paths = flows.prepare_reviews(spark, str(tmp_path / "raw.tsv"), str(tmp_path / "out"), fraction=1.0, key="at")
    reviews = spark.read.parquet(paths["cleaned"]).withColumnRenamed("product_id", "part")
    stats = extractive.fit_word_stats(reviews, "review_body")
    groups = flows.summaries_by_group(reviews.withColumnRenamed("part", "product"), stats, "product", "review_body", "at")
    rows = groups.collect()
    assert {r["product"]: r.n for r in rows} == {"hot": 80, "p0": 10, "p1": 10, "p2": 10, "p3": 10}
    assert all(r.summary and "<" not in r.reviews for r in rows)


def test_batches_of_similar_length_give_each_row_its_own_summary(spark):
    rows = [(i, "x" * (i * 37 % 101) if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "row int, text string").repartition(3)

    def same_lengths(texts):
        assert len(texts) <= 4
        return [f"{len(t)} of {max(map(len, texts))}" for t in texts]

    got = {r.row: r.summary for r in models.summarize(df, "text", same_lengths, batch_size=4, prefix="").collect()}
    assert {i: s and int(s.split()[0]) for i, s in got.items()} == {i: t if t is None else len(t) for i, t in rows}
    wide = sum(int(s.split()[2]) for s in got.values() if s)
    assert wide < 1.1 * sum(len(t) for _, t in rows if t)
    sizes = models.padded_sizes(df, "text", 4).first()
    assert (sizes.texts, sizes.chars) == (len([t for _, t in rows if t is not None]), sum(len(t) for _, t in rows if t))
    assert sizes.chars <= sizes.by_length < 1.1 * sizes.chars
    assert sizes.as_they_come > 1.3 * sizes.by_length
    assert tuple(models.padded_sizes(df.limit(0), "text").first()) == (0, 0, 0, 0)


def test_a_stream_reaches_the_model_in_small_arrow_batches(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")  # what a session says that nobody has set up
    session.range(3000).selectExpr("id", "'a text' AS text").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = session.readStream.schema("id long, text string").parquet(f"{tmp_path}/in")
    # A call gets no more than one Arrow batch.
    out = streaming.summarize_stream(
        stream, "text", lambda texts: [str(len(texts))] * len(texts), f"{tmp_path}/out", f"{tmp_path}/checkpoint", batch_size=3000, available_now=True
    )
    out.awaitTermination()
    sizes = session.read.parquet(f"{tmp_path}/out").groupBy("summary").count().collect()
    assert {r["summary"]: r["count"] for r in sizes} == {"2000": 2000, "1000": 1000}


def test_sentences_read_their_counts_by_place(spark):
    """A slice goes through all words of the text, once for each sentence."""
    docs = spark.createDataFrame([(1, "One two. Three one! ..."), (2, None)], "k long, text string")
    stats = extractive.fit_word_stats(docs, "text")
    scored = extractive.score_sentences(docs, stats, "text", "lines")
    assert "slice(" not in scored._jdf.queryExecution().analyzed().toString()
    found = {r["k"]: [(x["sentence"], x["score"]) for x in r["lines"]] for r in scored.collect()}
    assert found == {1: [("One two.", 1.5), ("Three one!", 1.5), ("...", 0.0)], 2: []}
