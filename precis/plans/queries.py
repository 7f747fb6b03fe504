"""One query per operator over the given tables; `oracle.py` holds the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from precis.functions import stemming
from precis.functions import text as txt
from precis.functions import tokens as tok
from precis.operators import batches, cleaning, evaluation, extractive, groups, models, rouge, rows, sampling, sentences, subwords, vocabulary
from precis.plans import flows
from precis.session import scratch_folder, spread, stored
from precis.sources import pairs as pair_files
from precis.sources import reviews as review_files
from precis.streaming import summaries as streaming

Query = Callable[[SparkSession, str], DataFrame]
# What names a row of each table.
KEYS = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}
# Joins the pieces of arrays for output; occurs in no text.
UNIT = "\x1f"
# The largest length and number of tokens that ids and arrays can count.
NO_LIMIT = 2**31 - 16
# The published tokenizer's id for the end of a text.
SUBWORD_END = 50_256


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/{name}.parquet"), *KEYS[name])


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source", "text")


def page_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Web pages as reviews: the host is the product, the title the headline, the page the body."""
    return table(spark, sf, "pages").select(
        "page_id",
        F.regexp_extract("url", "://([^/]+)/", 1).alias("product_id"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("review_headline"),
        F.col("html").alias("review_body"),
    )


def answers(spark: SparkSession, sf: str) -> DataFrame:
    """`(conv_id, turn, prediction, reference)`: each answer and the turn of the user before it."""
    turns = table(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    said = turns.filter("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prediction"))
    # Both columns name a turn, so no key of this join is hot.
    return said.join(asked, ["conv_id", "turn"])


def three_way(df: DataFrame, key: str) -> DataFrame:
    share = sampling.key_hash(F.col(key)) / sampling.HASH_RANGE
    return df.withColumn(
        "split", F.when(share < 0.8, "train").when(share < 0.9, "validation").otherwise("test")
    )


def flat(ids: Column) -> Column:
    return F.concat_ws(",", F.transform(ids, lambda i: i.cast("string")))


def longest_word(texts: list[str]) -> list[str]:
    """A model that reads whole texts and is easy to state in SQL as well: how many words, and the longest of them."""
    words = [[word for word in text.split(" ") if word] for text in texts]
    return [f"{len(each)} {max(each, key=lambda w: (len(w), w), default='')}" for each in words]


def talk(spark: SparkSession, sf: str) -> DataFrame:
    """`(id, text, summary)`: what an assistant says, and the turn before it as the second text of the pair."""
    row = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    return answers(spark, sf).select(row, F.col("prediction").alias("text"), F.col("reference").alias("summary"))


# Files


def read_reviews(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "reviews")
    plain = F.regexp_replace("text", "[\t\r\n]+", " ")
    raw = documents(spark, sf).select("doc_id", "source", plain.alias("text"))
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(sep="\t", header=True, quote="", compression="gzip", **options).csv(path)
    return review_files.read_reviews(spark, path, quote="")


def read_damaged_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as tab-separated lines, some with an unclosed quote, some without their last field."""
    path = scratch_folder(spark, "damaged")
    plain = F.regexp_replace("text", "[\t\r\n\"]+", " ")
    source = F.concat(F.when(F.col("doc_id") % 7 == 3, F.lit('"')).otherwise(F.lit("")), F.col("source"))
    text = F.when(F.col("doc_id") % 11 != 5, F.concat(F.lit("\t"), plain)).otherwise(F.lit(""))
    line = F.concat(F.col("doc_id").cast("string"), F.lit("\t"), source, text).alias("value")
    documents(spark, sf).select(line).write.option("compression", "gzip").text(path)
    schema = "doc_id string, source string, text string"
    return review_files.read_damaged_reviews(spark, path, StructType.fromDDL(schema))


def read_json_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON lines of four shapes: text as a string, in a list, in an object, and without a summary."""
    path = scratch_folder(spark, "lines")
    row = F.col("doc_id").alias("doc_id"), F.col("source").alias("summary")
    shapes = [
        F.to_json(F.struct(*row, F.col("text").alias("text"))),
        F.to_json(F.struct(*row, F.array(F.col("source"), F.col("text")).alias("text"))),
        F.to_json(F.struct(*row, F.struct(F.col("text").alias("body"), (F.col("doc_id") % 100).alias("at")).alias("text"))),
        F.to_json(F.struct(row[0], F.col("text").alias("text"))),
    ]
    shape = F.coalesce(*[F.when(F.col("doc_id") % 4 == i, made) for i, made in enumerate(shapes)])
    documents(spark, sf).select(shape.alias("value")).write.text(path)
    back = pair_files.read_pairs(spark, train=path, formats={"train": "json"}, fields=["doc_id", "text", "summary"])
    # An object's or a list's spelling is its own: the query shows what is in it.
    nested = F.when(F.col("doc_id").cast("long") % 4 == 1, F.get_json_object("text", "$[1]")).when(F.col("doc_id").cast("long") % 4 == 2, F.get_json_object("text", "$.body"))
    at = F.when(F.col("doc_id").cast("long") % 4 == 2, F.get_json_object("text", "$.at"))
    return back.select("split", "doc_id", F.coalesce(nested, F.col("text")).alias("text"), at.alias("place"), "summary")


def read_pairs(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "pairs")
    split = sampling.hash_split(documents(spark, sf).select("doc_id", "text", F.col("source").alias("summary")), "doc_id")
    both = split.select("split", F.col("doc_id").cast("string").alias("doc_id"), "text", "summary")
    one = {name: both.filter(F.col("split") == name).drop("split") for name in ("train", "validation")}
    pair_files.write_pairs_csv(one["train"], f"{path}/train.csv")
    one["validation"].write.json(f"{path}/validation.json")
    back = pair_files.read_pairs(spark, f"{path}/train.csv", f"{path}/validation.json", multiline=True)  # raw texts
    return back.select("split", "doc_id", "text", "summary")


def save_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "cleaned")
    review_files.save_cleaned(cleaning.clean_reviews(page_reviews(spark, sf)), path, "parquet")
    return review_files.load_cleaned(spark, path, "parquet")


def write_pairs_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "csv")
    pairs = rows.to_pairs(documents(spark, sf), "text", "source")
    pair_files.write_pairs_csv(pairs, path)
    return spark.read.options(**pair_files.CSV_OPTIONS, multiLine=True).csv(path)


def write_predictions(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "predictions")
    pair_files.write_predictions(documents(spark, sf), path, "text", "doc_id")
    return spark.read.text(path).select("value")


def write_metrics(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "metrics")
    pair_files.write_metrics(mean_metrics(spark, sf), path)
    return spark.read.json(path)


# Rows


def project_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return rows.project_reviews(page_reviews(spark, sf))


def to_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return rows.to_pairs(page_reviews(spark, sf))


def keep_non_empty(spark: SparkSession, sf: str) -> DataFrame:
    # Documents without an ASCII word of ten letters lose their `long_word`.
    df = documents(spark, sf).withColumn("long_word", F.regexp_extract("text", "[a-z]{10,}", 0))
    return rows.keep_non_empty(df.select("doc_id", "source", "long_word"), ["source", "long_word"])


def drop_incomplete_pairs(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    text = F.when(F.col("role") == "system", F.lit("")).otherwise(F.col("text"))
    summary = F.when(F.col("turn") > 0, F.col("role"))
    return rows.drop_incomplete_pairs(turns.select("conv_id", "turn", text.alias("text"), summary.alias("summary")))


def resolve_columns(spark: SparkSession, sf: str) -> DataFrame:
    named = documents(spark, sf).select("doc_id", F.col("text").alias("document"), F.col("source").alias("label"))
    return rows.resolve_columns(named, dataset="xsum", summary="label", keep=("doc_id",))


def add_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return rows.add_prefix(documents(spark, sf), "text")


def head_samples(spark: SparkSession, sf: str) -> DataFrame:
    return rows.head_samples(documents(spark, sf), 100, "doc_id")


def preview(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows a preview has, how many of them are rows of the table, and how many differ."""
    docs = documents(spark, sf).select("doc_id", "text")
    known = docs.withColumn("known", F.lit(1))
    found = rows.preview(docs, "doc_id", "text").join(known, ["doc_id", "text"], "left")
    return found.agg(F.count("*").alias("n"), F.count("known").alias("known"), F.count_distinct("doc_id").alias("distinct_rows"))


def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rows.split_counts(three_way(documents(spark, sf), "doc_id"), max_samples=500)


# Cleaning


def strip_markup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", txt.strip_markup(F.col("html")).alias("text"))


def truncate_at_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", txt.truncate_at_sentence(F.col("text"), 50).alias("text"))


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", txt.clean_text(F.col("text"), 100).alias("text"))


def clean_text_short(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return turns.select("conv_id", "turn", txt.clean_text(F.col("text"), 20).alias("text"))


def clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_reviews(page_reviews(spark, sf))


# Samples


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a sample of a tenth repeats, is part of the table, and has about that share (five deviations)."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    once, again = (sampling.sample_rows(docs).withColumn(name, F.lit(1)) for name in ("once", "again"))
    both = docs.join(once, "doc_id", "full").join(again, "doc_id", "full")
    taken, every = F.count("once"), F.count("*")
    return both.agg(
        every.alias("n"),
        (F.count(F.when(F.col("once").eqNullSafe(F.col("again")), 1)) == every).alias("repeats"),
        (F.abs(taken - 0.1 * every) <= 5 * F.sqrt(0.09 * every)).alias("about_a_tenth"),
    )


def random_split(spark: SparkSession, sf: str) -> DataFrame:
    """The two parts put together again are the table, no row lost or twice, and the first has its share."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source")
    train, validation = sampling.random_split(docs)
    both = train.withColumn("first", F.lit(1)).unionByName(validation.withColumn("first", F.lit(0)))
    known = both.join(docs, ["doc_id", "source"])
    every = F.count("*")
    return known.agg(
        every.alias("n"),
        F.count_distinct("doc_id").alias("distinct_rows"),
        (F.abs(F.sum("first") - 0.8 * every) <= 5 * F.sqrt(0.16 * every)).alias("about_four_fifths"),
    )


def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_sample(documents(spark, sf), "doc_id").select("doc_id", "source")


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_split(documents(spark, sf), "doc_id").select("doc_id", "split")


# Groups


def collect_texts(spark: SparkSession, sf: str) -> DataFrame:
    lists = groups.collect_texts(documents(spark, sf), "source", "text", "doc_id")
    return lists.select("source", "part", "n", F.concat_ws(UNIT, "texts").alias("texts"))


def count_rows(spark: SparkSession, sf: str) -> DataFrame:
    return groups.count_rows(documents(spark, sf), "source")


def min_group_size(spark: SparkSession, sf: str) -> DataFrame:
    return groups.min_group_size(groups.count_rows(table(spark, sf, "conversations"), "conv_id"), 4)


def concat_texts(spark: SparkSession, sf: str) -> DataFrame:
    lists = groups.collect_texts(table(spark, sf, "conversations"), "conv_id", "text", "turn")
    return lists.select("conv_id", groups.concat_texts(F.col("texts")).alias("text"))


def review_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return groups.review_by_group(documents(spark, sf), "source", "text", "doc_id")


def review_by_group_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    return groups.review_by_group(documents(spark, sf), "source", "text", "doc_id", max_part_chars=20_000)


def model_input_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return groups.model_input_by_group(documents(spark, sf), "source", "text", "doc_id")


def mean_metrics(spark: SparkSession, sf: str) -> DataFrame:
    scored = rouge_1(spark, sf).withColumn("split", F.when(F.col("turn") > 1, "later").otherwise("first"))
    return evaluation.mean_metrics(scored, ["precision", "recall", "f1"], "turn")


# Token arrays


def _vocab(docs: DataFrame, size: int = 2000) -> DataFrame:
    return vocabulary.build_vocab(docs, "text", size)


def build_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return _vocab(documents(spark, sf))


def _encoded(spark: SparkSession, sf: str, length: int) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return vocabulary.encode(docs, _vocab(docs), {"ids": ("text", length)}, keep=["doc_id"])


def encode(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf, 1024).select("doc_id", flat(F.col("ids")).alias("input_ids"))


def encode_whole_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """With every token of the corpus in the vocabulary, joined by a shuffle: the branch of rare tokens."""
    docs = documents(spark, sf).select("doc_id", "text")
    vocab = vocabulary.build_vocab(docs, "text", 10_000_000)
    ids = vocabulary.encode(docs, vocab.hint("shuffle_merge"), {"ids": ("text", 1024)}, keep=["doc_id"])
    return ids.select("doc_id", flat(F.col("ids")).alias("input_ids"))


def _pair_ids(spark: SparkSession, sf: str, **settings) -> DataFrame:
    pairs = talk(spark, sf)
    return vocabulary.encode_pairs(pairs, vocabulary.build_vocab(pairs, "text"), **settings)


def encode_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """With the library's vocabulary size and lengths, targets by the limit of evaluation rows, nothing padded."""
    ids = _pair_ids(spark, sf, validation=True, val_max_target_length=64)
    return ids.select("id", flat(F.col("input_ids")).alias("input_ids"), flat(F.col("labels")).alias("labels"))


def encode_pairs_at_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """With the library's vocabulary size and lengths, padded to them."""
    ids = _pair_ids(spark, sf, pad_to_max_length=True)
    return ids.select("id", flat(F.col("input_ids")).alias("input_ids"), flat(F.col("labels")).alias("labels"))


def pad_to_length(spark: SparkSession, sf: str) -> DataFrame:
    return _encoded(spark, sf, 1024).select("doc_id", flat(tok.pad_to_length(F.col("ids"), 1024)).alias("ids"))


def mask_labels(spark: SparkSession, sf: str) -> DataFrame:
    padded = tok.pad_to_length(F.col("ids"), 1024)
    return _encoded(spark, sf, 1024).select("doc_id", flat(tok.mask_labels(padded)).alias("ids"))


def generated_length(spark: SparkSession, sf: str) -> DataFrame:
    padded = tok.mask_labels(tok.pad_to_length(F.col("ids"), 1024))
    return _encoded(spark, sf, 1024).select("doc_id", tok.generated_length(padded).alias("n"))


def _padded(padded: DataFrame, *more: str) -> DataFrame:
    return padded.select("id", *more, "batch", flat(F.col("input_ids")).alias("input_ids"), flat(F.col("labels")).alias("labels"))


def pad_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches over the whole table, lengths rounded up to eight."""
    return _padded(batches.pad_batches(_pair_ids(spark, sf), "id", multiple_of=8))


def pad_batches_at_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return _padded(batches.pad_batches(_pair_ids(spark, sf), "id"))


def decode(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of the library's vocabulary size and source length, padded and masked as a model would give them."""
    docs = documents(spark, sf).select("doc_id", "text")
    vocab = stored(vocabulary.build_vocab(docs, "text"), "vocab")
    ids = vocabulary.encode(docs, vocab, {"ids": ("text", vocabulary.MAX_SOURCE_LENGTH)}, keep=["doc_id"])
    padded = ids.select("doc_id", tok.mask_labels(tok.pad_to_length(F.col("ids"), vocabulary.MAX_SOURCE_LENGTH)).alias("text"))
    return vocabulary.decode(padded, vocab, ["text"])


def decode_whole_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of whole texts with every token of the corpus in the vocabulary; all words come back."""
    docs = documents(spark, sf).select("doc_id", "text")
    vocab = stored(_vocab(docs, NO_LIMIT), "vocab")
    ids = vocabulary.encode(docs, vocab, {"ids": ("text", NO_LIMIT)}, keep=["doc_id"])
    return vocabulary.decode(ids.select("doc_id", F.col("ids").alias("text")), vocab, ["text"])


def subword_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts as ids of a published subword tokenizer, with its end id, and back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    ids = subwords.encode_subwords(documents(spark, sf).select("doc_id", "text"), path, {"ids": ("text", None)}, SUBWORD_END)
    ended = (F.element_at("ids", -1) == SUBWORD_END).alias("ended")
    return subwords.decode_subwords(ids.select("doc_id", ended, F.col("ids").alias("text")), path, ["text"], (SUBWORD_END,))


# Scores


def newline_sentences(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select("doc_id", txt.newline_sentences(F.col("text")).alias("text"))


def learned_abbreviations(spark: SparkSession, sf: str) -> DataFrame:
    """What the corpus says about each word that a full stop follows anywhere."""
    rated = sentences.rate_abbreviations(stored(sentences.word_types(documents(spark, sf), "text"), "word-types"))
    return rated.filter("n_stop > 0").select("word", "n_stop", "n_other", (F.round("score", 6) + 0.0).alias("score"), "abbreviation")


def learned_sentences(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("doc_id", "text")
    return sentences.learned_sentences(docs, sentences.learn_sentence_ends(docs, "text"), "text", "text")


def _scores(df: DataFrame, score: Column) -> DataFrame:
    return df.withColumn("_score", score).select("conv_id", "turn", "_score.precision", "_score.recall", "_score.f1")


def rouge_1(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(answers(spark, sf), rouge.rouge_n(F.col("prediction"), F.col("reference"), 1))


def rouge_2(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(answers(spark, sf), rouge.rouge_n(F.col("prediction"), F.col("reference"), 2))


def rouge_1_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    sides = F.col("prediction"), F.col("reference")
    return _scores(answers(spark, sf), rouge.rouge_n(*sides, 1, stemming.stemmed_tokens))


def rouge_l(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(answers(spark, sf), rouge.rouge_l(F.col("prediction"), F.col("reference")))


def rouge_lsum(spark: SparkSession, sf: str) -> DataFrame:
    lines = {side: txt.newline_sentences(F.col(side)) for side in ("prediction", "reference")}
    scored = rouge.add_rouge_lsum(answers(spark, sf).withColumns(lines), "prediction", "reference", "_score")
    return scored.select("conv_id", "turn", "_score.precision", "_score.recall", "_score.f1")


def evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """Answers scored from ids as evaluation does by default: ids with sentence ends, decoded, set in sentences, scored on
    word stems, averaged per kind of conversation."""
    vocab = stored(vocabulary.build_vocab(table(spark, sf, "conversations"), "text", tokenize=tok.sentence_tokens), "vocab")
    longest = vocabulary.MAX_TARGET_LENGTH
    sides = {"prediction_ids": ("prediction", longest), "labels": ("reference", longest)}
    ids = vocabulary.encode(answers(spark, sf), vocab, sides, tok.sentence_tokens)
    split = F.when(F.col("turn") == 1, "first").otherwise("later")
    return evaluation.evaluate_ids(ids.withColumn("split", split), vocab)


# Summaries


def fit_word_stats(spark: SparkSession, sf: str) -> DataFrame:
    return extractive.fit_word_stats(documents(spark, sf), "text")


def summarize(spark: SparkSession, sf: str) -> DataFrame:
    return models.summarize(documents(spark, sf), "text", longest_word).select("doc_id", "summary")


def padded_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """What a model has to read, and whether batches by length spare it some padding."""
    sizes = models.padded_sizes(documents(spark, sf), "text")
    return sizes.select("texts", "chars", (F.col("by_length") < F.col("as_they_come")).alias("spared"), (F.col("by_length") >= F.col("chars")).alias("holds_all"))


def summarize_extractive(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return extractive.summarize_extractive(docs, extractive.fit_word_stats(docs, "text"), "doc_id", "text")


def summarize_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: texts cleaned, grouped by source, each group of ten or more summarized."""
    cleaned = stored(cleaning.clean_column(documents(spark, sf), "text", 100), "cleaned")
    cleaned = spread(cleaned, "doc_id")
    stats = stored(extractive.fit_word_stats(cleaned, "text"), "word_stats")
    return flows.summaries_by_group(cleaned, stats, "source", "text", "doc_id")


def summarize_groups_in_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same with groups that need several rows; the summary stands on each of them."""
    cleaned = stored(cleaning.clean_column(documents(spark, sf), "text", 100), "cleaned")
    cleaned = spread(cleaned, "doc_id")
    stats = stored(extractive.fit_word_stats(cleaned, "text"), "word_stats")
    return flows.summaries_by_group(cleaned, stats, "source", "text", "doc_id", max_part_chars=5_000)


def summarize_groups_by_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return flows.model_summaries_by_group(docs, longest_word, "source", "text", "doc_id")


def predict(spark: SparkSession, sf: str) -> DataFrame:
    """The whole second flow; the result is the lines of the predictions file."""
    data = three_way(talk(spark, sf), "id")
    paths = flows.train_evaluate_predict(data, scratch_folder(spark, "predict"), "id")
    return spark.read.text(paths["predictions"]).select("value")


def export_training_data(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of conversations as padded batches per split, read back; lengths rounded up, shorter targets in evaluation."""
    data = three_way(talk(spark, sf), "id")
    paths = flows.export_training_data(data, scratch_folder(spark, "export"), "id", val_max_target_length=64, multiple_of=8)
    return _padded(spark.read.parquet(paths["batches"]), "split")


def export_training_data_at_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """With the library's vocabulary size and lengths."""
    data = three_way(talk(spark, sf), "id")
    paths = flows.export_training_data(data, scratch_folder(spark, "export"), "id")
    return _padded(spark.read.parquet(paths["batches"]), "split")


def _raw_reviews(spark: SparkSession, sf: str, path: str) -> str:
    """The page reviews as gzipped tab-separated files."""
    plain = F.regexp_replace("review_body", "[\t\r\n]+", " ").alias("review_body")
    raw = page_reviews(spark, sf).select("page_id", "product_id", "review_headline", plain)
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.write.options(sep="\t", header=True, quote="", compression="gzip", **options).csv(path)
    return path


def prepare_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """The whole first flow on all rows; the result is both CSV folders put together."""
    out = scratch_folder(spark, "prepare")
    paths = flows.prepare_reviews(spark, _raw_reviews(spark, sf, f"{out}/raw"), out, fraction=1.0, quote="")
    folders = {"train": "csv", "validation": "csv"}
    both = pair_files.read_pairs(spark, paths["train"], paths["validation"], formats=folders)
    return both.select("text", "summary")


def prepare_reviews_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The same on half the rows, sampled and split by the page's id."""
    out = scratch_folder(spark, "prepare")
    raw = _raw_reviews(spark, sf, f"{out}/raw")
    paths = flows.prepare_reviews(spark, raw, out, fraction=0.5, quote="", key="page_id")
    folders = {"train": "csv", "validation": "csv"}
    return pair_files.read_pairs(spark, paths["train"], paths["validation"], formats=folders)


def _document_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path).select("doc_id", "text")


def summarize_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a stream of files through the model; the result is the sink's table."""
    out = scratch_folder(spark, "stream")
    stream = _document_stream(spark, f"{sf}/document[s].parquet")  # a pattern: a stream takes a single file by no other path
    query = streaming.summarize_stream(stream, "text", longest_word, f"{out}/sink", f"{out}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.parquet(f"{out}/sink").select("doc_id", "summary")


def summarize_stream_once(spark: SparkSession, sf: str) -> DataFrame:
    """The documents delivered as files, and after a restart once more: each has one summary."""
    out = scratch_folder(spark, "stream")
    for _ in range(2):
        documents(spark, sf).select("doc_id", "text").write.mode("append").parquet(f"{out}/files")
        stream = _document_stream(spark, f"{out}/files")
        query = streaming.summarize_stream(stream, "text", longest_word, f"{out}/sink", f"{out}/checkpoint", available_now=True, key="doc_id")
        query.awaitTermination()
    return spark.read.parquet(f"{out}/sink").select("doc_id", "summary")


def summarize_stream_extractive(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a stream of files, summarized by extraction with the documents' own word counts."""
    out = scratch_folder(spark, "stream")
    stats = stored(extractive.fit_word_stats(documents(spark, sf), "text"), "word-stats")
    stream = _document_stream(spark, f"{sf}/document[s].parquet")
    query = streaming.summarize_stream_extractive(stream, stats, "doc_id", "text", f"{out}/sink", f"{out}/checkpoint", available_now=True)
    query.awaitTermination()
    return spark.read.parquet(f"{out}/sink").select("doc_id", "summary")


def map_batches(spark: SparkSession, sf: str) -> DataFrame:
    def count_words(batch):
        batch = batch[batch["text"].str.len() >= 500]
        return batch[["doc_id"]].assign(words=batch["text"].str.count(" ") + 1)

    return models.map_batches(documents(spark, sf).select("doc_id", "text"), count_words, "doc_id bigint, words bigint")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        read_reviews,
        read_damaged_reviews,
        read_pairs,
        read_json_fields,
        save_cleaned,
        write_pairs_csv,
        write_predictions,
        write_metrics,
        project_reviews,
        to_pairs,
        keep_non_empty,
        drop_incomplete_pairs,
        resolve_columns,
        add_prefix,
        head_samples,
        preview,
        split_counts,
        strip_markup,
        truncate_at_sentence,
        clean_text,
        clean_text_short,
        clean_reviews,
        sample_rows,
        random_split,
        hash_sample,
        hash_split,
        collect_texts,
        count_rows,
        min_group_size,
        concat_texts,
        review_by_group,
        review_by_group_in_parts,
        model_input_by_group,
        mean_metrics,
        build_vocab,
        encode,
        encode_whole_vocabulary,
        encode_pairs,
        encode_pairs_at_defaults,
        pad_to_length,
        mask_labels,
        generated_length,
        pad_batches,
        pad_batches_at_defaults,
        decode,
        decode_whole_texts,
        subword_round_trip,
        newline_sentences,
        learned_abbreviations,
        learned_sentences,
        rouge_1,
        rouge_2,
        rouge_1_stemmed,
        rouge_l,
        rouge_lsum,
        evaluate,
        fit_word_stats,
        summarize,
        padded_sizes,
        summarize_extractive,
        summarize_groups,
        summarize_groups_in_parts,
        summarize_groups_by_model,
        predict,
        export_training_data,
        export_training_data_at_defaults,
        prepare_reviews,
        prepare_reviews_by_key,
        summarize_stream,
        summarize_stream_once,
        summarize_stream_extractive,
        map_batches,
    )
}
