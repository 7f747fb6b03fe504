"""The three flows, each from stored tables to stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.operators.batches import pad_batches
from precis.operators.cleaning import clean_reviews
from precis.operators.evaluation import evaluate_texts
from precis.operators.extractive import MAX_TOKENS, MIN_TOKENS, add_summaries, fit_word_stats, summarize_extractive
from precis.operators.groups import (
    MAX_PART_CHARS,
    concat_texts,
    lay_out,
    model_input_by_group,
    review_by_group,
    texts_in_order,
)
from precis.operators.models import Model, summarize
from precis.operators.rows import (
    add_prefix,
    drop_incomplete_pairs,
    head_samples,
    project_reviews,
    resolve_columns,
    split_counts,
    to_pairs,
)
from precis.operators.sampling import hash_sample, hash_split, random_split, sample_rows
from precis.operators.vocabulary import MAX_SOURCE_LENGTH, MAX_TARGET_LENGTH, VOCAB_SIZE, build_vocab, encode_pairs
from precis.sources.pairs import write_metrics, write_pairs_csv, write_predictions
from precis.sources.reviews import load_cleaned, read_reviews, save_cleaned


def prepare_reviews(
    spark: SparkSession,
    raw: str | list[str],
    out: str,
    fraction: float = 0.1,
    train: float = 0.8,
    seed: int = 42,
    quote: str | None = '"',
    partitions: int | None = None,
    key: str | None = None,
) -> dict[str, str]:
    """Raw reviews to a cleaned table and CSV pairs per split; gives the paths.

    The cleaned table is stored before it is split: the split then reads the same rows each time, and no text is
    cleaned twice. With a row `key`, rows are sampled and split by its hash, which repeats however the files are laid
    out and writes both splits in one pass; without one, by Spark's generator in a pass and a sort per split.
    """
    more = [] if key is None else [key]
    reviews = project_reviews(read_reviews(spark, raw, quote=quote, partitions=partitions), *more)
    sample = sample_rows(reviews, fraction, seed) if key is None else hash_sample(reviews, key, fraction, seed)
    save_cleaned(clean_reviews(sample), f"{out}/cleaned")
    cleaned = load_cleaned(spark, f"{out}/cleaned")
    if key is not None:
        # Another seed: the sample has already used up the low hashes of this one.
        split = hash_split(cleaned, key, train, seed + 1)
        names = {"split": "split", "review_body": "text", "review_headline": "summary"}
        write_pairs_csv(split.select(*[F.col(old).alias(new) for old, new in names.items()]), f"{out}/pairs")
        return {"cleaned": f"{out}/cleaned"} | {s: f"{out}/pairs/split={s}" for s in ("train", "validation")}
    paths = {name: f"{out}/{name}" for name in ("cleaned", "train", "validation")}
    for name, part in zip(("train", "validation"), random_split(to_pairs(cleaned), train, seed), strict=True):
        write_pairs_csv(part, paths[name])
    return paths


def predict_pairs(
    pairs: DataFrame,
    stats: DataFrame | None = None,
    model: Model | None = None,
    prefix: str | None = "summarize: ",
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """`pairs` with a `prediction`, by the given model or else by extraction with the given word counts."""
    if model is not None:
        return summarize(pairs, "text", model, prefix=prefix, into="prediction")
    if stats is None:
        raise ValueError("extraction needs word counts")
    return add_summaries(pairs, stats, "text", "prediction", min_tokens, max_tokens)


def train_evaluate_predict(
    data: DataFrame,
    out: str,
    key: str,
    dataset: str | None = None,
    text: str | None = None,
    summary: str | None = None,
    model: Model | None = None,
    max_samples: dict[str, int] | None = None,
) -> dict[str, str]:
    """Splits of pairs to word counts, metrics and predictions; gives the paths.

    `data` has a `split` and a row `key`. Word counts are fitted on `train` and stored, `validation` is scored, and
    `test`, when there, is predicted and scored. `max_samples` keeps the first rows of a split by key.
    """
    spark = data.sparkSession
    pairs = drop_incomplete_pairs(
        resolve_columns(data, dataset, text, summary, keep=("split", key)).withColumnRenamed(key, "id")
    )
    paths = {name: f"{out}/{name}" for name in ("word_stats", "metrics", "scored", "predictions")}

    def part(split: str) -> DataFrame:
        rows = pairs.filter(F.col("split") == split)
        limit = (max_samples or {}).get(split)
        return rows if limit is None else head_samples(rows, limit, "id")

    present = {r["split"] for r in pairs.select("split").distinct().limit(100).collect()}  # a few names
    for needed in ("train", "validation"):
        if needed not in present:
            raise ValueError(f"the data has no rows of split {needed!r}")
    save_cleaned(fit_word_stats(part("train"), "text"), paths["word_stats"])
    stats = load_cleaned(spark, paths["word_stats"])
    held_out = part("validation").unionByName(part("test"))
    save_cleaned(predict_pairs(held_out, stats, model), paths["scored"])
    scored = load_cleaned(spark, paths["scored"])
    # The train split has a record too: how many rows were used.
    rows = split_counts(part("train")).unionByName(evaluate_texts(scored, "prediction", "summary"), allowMissingColumns=True)
    write_metrics(rows, paths["metrics"])
    write_predictions(scored.filter(F.col("split") == "test"), paths["predictions"], "prediction", "id")
    return paths


def export_training_data(
    data: DataFrame,
    out: str,
    key: str,
    vocab_size: int = VOCAB_SIZE,
    prefix: str | None = "summarize: ",
    max_source_length: int = MAX_SOURCE_LENGTH,
    max_target_length: int = MAX_TARGET_LENGTH,
    val_max_target_length: int | None = None,
    batch_size: int = 8,
    multiple_of: int | None = None,
    max_samples: dict[str, int] | None = None,
) -> dict[str, str]:
    """Splits of `(text, summary)` pairs to a vocabulary and padded batches of ids per split; gives the paths.

    `data` has a `split` and a row `key`. Incomplete pairs go, the vocabulary is built from the `train` texts and
    summaries with their prefix, and every split is encoded with it, batched and stored below `batches/split=...`.
    Splits other than `train` take the validation limit for their targets.
    """
    spark = data.sparkSession
    pairs = drop_incomplete_pairs(data.select("split", F.col(key).alias("id"), "text", "summary"))
    pairs = add_prefix(pairs, "text", prefix)

    def part(split: str) -> DataFrame:
        rows = pairs.filter(F.col("split") == split)
        limit = (max_samples or {}).get(split)
        return rows if limit is None else head_samples(rows, limit, "id")

    paths = {"vocab": f"{out}/vocab", "batches": f"{out}/batches"}
    both = part("train").select("text").union(part("train").select("summary"))
    save_cleaned(build_vocab(both, "text", vocab_size), paths["vocab"])
    vocab = load_cleaned(spark, paths["vocab"])
    for split in ("train", "validation", "test"):
        ids = encode_pairs(
            part(split), vocab, max_source_length, max_target_length, val_max_target_length, validation=split != "train"
        )
        padded = pad_batches(ids, "id", batch_size, multiple_of=multiple_of)
        save_cleaned(padded.withColumnRenamed("id", key), f"{paths['batches']}/split={split}")
    return paths


def summaries_by_group(
    reviews: DataFrame,
    stats: DataFrame,
    key: str,
    text: str,
    order: str,
    min_n: int = 10,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    max_part_chars: int = MAX_PART_CHARS,
) -> DataFrame:
    """`(key, part, n, reviews, summary)`: each group's texts and one summary of them all.

    The summary is made from the single sentences, never from the joined text. It then goes to each part of its group
    as one more row of the grouping that puts the texts together, so the texts are moved once.
    """
    summaries = summarize_extractive(
        reviews, stats, key, text, order, min_tokens=min_tokens, max_tokens=max_tokens
    )
    texts = lay_out(reviews, key, text, order, max_part_chars).withColumn("is_text", F.lit(1))
    # A part in which a long text leaves no room for others' beginnings has no rows; it is dropped below.
    last = texts.groupBy("group").agg(F.max("part").alias("last")).withColumnRenamed("group", "_key")
    placed = summaries.join(last, F.col(key).eqNullSafe(F.col("_key"))).select(
        F.col(key).alias("group"), F.explode(F.sequence(F.lit(0), F.col("last"))).alias("part"), "summary"
    )
    rows = F.count("is_text")
    return (
        texts.unionByName(placed, allowMissingColumns=True)
        .groupBy("group", "part")
        .agg(
            F.coalesce(F.max("total"), rows).alias("n"),
            rows.alias("rows"),
            texts_in_order().alias("entries"),
            F.max("summary").alias("summary"),
        )
        .filter((F.col("n") >= min_n) & (F.col("rows") > 0))
        .select(
            F.col("group").alias(key), "part", "n", concat_texts(F.col("entries.text")).alias("reviews"), "summary"
        )
    )


def model_summaries_by_group(
    reviews: DataFrame,
    model: Model,
    key: str,
    text: str,
    order: str,
    min_n: int = 10,
    max_tokens: int = 512,
    prefix: str | None = "summarize: ",
) -> DataFrame:
    """`(key, part, n, reviews, summary)`: each group's texts, and a summary by a model.

    The model is given no more than the `max_tokens` tokens that it reads of a group; `reviews` is the whole text.
    """
    read = model_input_by_group(reviews, key, text, order, min_n, max_tokens)
    made = summarize(read, "reviews", model, prefix=prefix).select(F.col(key).alias("_key"), "summary")
    whole = review_by_group(reviews, key, text, order, min_n)
    return whole.join(made, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
