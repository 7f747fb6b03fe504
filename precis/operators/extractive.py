"""Summaries made of a text's own sentences, after SumBasic (Nenkova and Vanderwende 2005) without re-weighting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import first_words, let, sentences, word_count
from precis.functions.tokens import word_tokens
from precis.operators.groups import first_rows
from precis.operators.lookups import looked_up
from precis.operators.vocabulary import Tokenizer, count_tokens

MIN_TOKENS = 50
MAX_TOKENS = 128


def fit_word_stats(train: DataFrame, text: str, tokenize: Tokenizer = word_tokens) -> DataFrame:
    """`(token, count, p)`: how often each word occurs in the training texts, and its share of all words."""
    counts = count_tokens(train, text, tokenize)
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("token", "count", (F.col("count") / total).alias("p"))


def score_sentences(
    df: DataFrame, stats: DataFrame, text: str, into: str, tokenize: Tokenizer = word_tokens, keep: list[str] | None = None
) -> DataFrame:
    """`df` with an array `into` of its sentences: `pos`, `sentence`, `score` and `cost`, its number of words.

    A score is the mean training count of the sentence's words. A text is cut into sentences and words once. Each block of
    rows asks once for each of its distinct words, so no sentence is a key; with `keep` only these columns of `df` are
    moved along. Every row stays, whatever its columns hold; null and blank texts have no sentences.
    """
    cut = df.withColumn("_sentences", sentences(F.coalesce(F.col(text), F.lit(""))))
    cut = cut.withColumn("_words", F.transform("_sentences", tokenize))
    cut = cut.withColumn("_sizes", F.transform("_words", lambda words: F.size(words)))
    kept = df.columns if keep is None else keep
    found = looked_up(cut, stats, {"_counts": F.flatten("_words")}, "token", "count", keep=[*kept, "_sentences", "_sizes"])

    # Where each sentence's words begin among all words of the text.
    ends = F.aggregate("_sizes", F.array(F.lit(0)), lambda to, n: F.concat(to, F.array(F.element_at(to, -1) + n)))

    def scored(bound: Column) -> Column:
        def one(line: Column, pos: Column) -> Column:
            size = F.get("_sizes", pos)
            # Read by place: a slice would go through all words of the text for each sentence.
            start = F.get(bound["starts"], pos)
            own = F.sequence(start, start + size - 1)
            weight = F.aggregate(own, F.lit(0).cast("bigint"), lambda total, at: total + F.coalesce(F.get(bound["counts"], at), F.lit(0)))
            score = F.when(size > 0, weight / size).otherwise(F.lit(0.0))
            return F.struct(pos.alias("pos"), line.alias("sentence"), score.alias("score"), word_count(line).alias("cost"))

        return F.transform("_sentences", one)

    # Bound outside the lambda, where they would be worked out anew for each sentence.
    bound = F.struct(F.col("_counts").alias("counts"), ends.alias("starts"))
    return found.select(*[F.col(f"`{c}`") for c in kept if c != into], let(bound, scored).alias(into))


def add_summaries(
    df: DataFrame,
    stats: DataFrame,
    text: str,
    into: str = "summary",
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    tokenize: Tokenizer = word_tokens,
    keep: list[str] | None = None,
) -> DataFrame:
    """`df` (or its columns `keep`) with a summary of each row's text: its best sentences in their order; empty for null and blank texts.

    Sentences are taken by score, ties by position, until `min_tokens` words are reached; the last one is cut where it
    would pass `max_tokens`.
    """
    none = F.array().cast("array<struct<pos:int,left:int>>")
    start = F.struct(F.lit(0).alias("before"), none.alias("picked"))

    def more(state: Column, x: Column) -> Column:
        left = F.struct(x["pos"].alias("pos"), (F.lit(max_tokens) - state["before"]).alias("left"))
        longer = F.struct((state["before"] + x["cost"]).alias("before"), F.concat(state["picked"], F.array(left)).alias("picked"))
        return F.when(state["before"] < min(min_tokens, max_tokens), longer).otherwise(state)

    def best(lines: Column) -> Column:
        ranked = F.sort_array(F.transform(lines, lambda x: F.struct((-x["score"]).alias("s"), x["pos"].alias("pos"), x["cost"].alias("cost"))))
        picked = F.sort_array(F.aggregate(ranked, start, more)["picked"])
        return F.concat_ws(" ", F.transform(picked, lambda p: first_words(F.get(lines, p["pos"])["sentence"], p["left"])))

    scored = score_sentences(df, stats, text, "_lines", tokenize, keep)
    return scored.withColumn(into, let(F.col("_lines"), best)).drop("_lines")


def summarize_extractive(
    df: DataFrame,
    stats: DataFrame,
    key: str,
    text: str,
    order: str | None = None,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    tokenize: Tokenizer = word_tokens,
) -> DataFrame:
    """`(key, summary)`: one row per row of `df`, see `add_summaries`; with `order` one row per key.

    `order` orders the rows of one key, whose texts then make up one document: a group is summarized without its texts
    being put together. Texts of equal order are told apart by a hash. A key without any sentence has no row.
    """
    if order is None:
        one = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        made = add_summaries(one, stats, "_text", "summary", min_tokens, max_tokens, tokenize, keep=["_key"])
        return made.select(F.col("_key").alias(key), "summary")
    one = df.select(F.col(key).alias("_key"), F.col(order).alias("_order"), F.xxhash64(text).alias("_tie"), F.col(text).alias("_text"))
    scored = score_sentences(one, stats, "_text", "_lines", tokenize, keep=["_key", "_order", "_tie"])
    ranked = scored.select("_key", "_order", "_tie", F.inline("_lines"))
    by = [F.desc("score"), F.asc("_order"), F.asc("_tie"), F.asc("pos")]
    # Each sentence costs at least one word, so no more than `min_tokens` of them are taken.
    ranked = first_rows(ranked, ["_key"], by, min_tokens)
    before = Window.partitionBy("_key").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    taken = (
        ranked.withColumn("before", F.coalesce(F.sum("cost").over(before), F.lit(0)))
        .filter((F.col("before") < min_tokens) & (F.col("before") < max_tokens))
        .withColumn("kept", first_words(F.col("sentence"), (F.lit(max_tokens) - F.col("before")).cast("int")))
    )
    return (
        taken.groupBy("_key")
        .agg(F.sort_array(F.collect_list(F.struct("_order", "_tie", "pos", "kept"))).alias("picked"))
        .select(F.col("_key").alias(key), F.concat_ws(" ", F.col("picked.kept")).alias("summary"))
    )
