"""One query per operator over its whole table, with production settings; `oracle.py` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from precis.llm import alignment, chat, decontamination, language, line_dedup, mixing, mtree, ngram_join, quality, token_counts, token_files, warc, whitening
from precis.llm.common import saved, table
from precis.session import scratch_folder


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in training order by the middle of their first pass, those that are never taken last."""
    planned = mixing.plan(table(spark, sf, "documents"))
    rows = planned.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
    return rows.select(
        F.col("_key").alias("doc_id"),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.size("_positions")).alias("taken"),
        F.round(F.get("_positions", F.lit(0)), 6).alias("position"),
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    lost = saved(line_dedup.removed_by_document(docs), "lines-lost")
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    every = docs.select("doc_id", lines.cast("long").alias("n_lines"), *ngram_join.row_names("doc_id", "text"))
    both = every.join(lost, ["_row", "_row2"], "left")
    removed = F.coalesce("removed", F.array().cast("array<bigint>"))
    return both.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.array_join(removed.cast("array<string>"), ",").alias("removed_lines"))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "warc")
    warc.write(table(spark, sf, "pages"), path)
    found = warc.read(spark, path)
    return found.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to", "intact"
    )


def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("_key").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    rated = quality.assess(table(spark, sf, "documents").select("doc_id", "text", "lang"), lang="lang")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rated.select(
        "doc_id",
        *(F.col(f"quality.counts.{c}").alias(c) for c in base),
        F.array_contains("quality.broken", "base").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
        F.concat_ws(",", "quality.broken").alias("broken"),
    )


def op6_chat(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "chat")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    # Texts that look like the template itself.
    said = F.lit("</s>[INST] ok [/INST]")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    chat.write(turns.unionByName(tricky), path)
    found = chat.digests(spark, path)
    return found.select(
        F.col("conv").alias("conv_id"), F.col("n_turns").cast("long").alias("n_turns"), "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )


def op7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    found = decontamination.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(
        F.col("_key").alias("doc_id"),
        F.col("_item").alias("item_id"),
        F.col("_n").cast("long").alias("n_shingles"),
        F.col("_shared").alias("n_shared"),
    )


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.withColumnRenamed("_key", "doc_id")


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_folder(spark, "token-ids")
    token_files.write(table(spark, sf, "documents"), path, tokenizer_path())
    return token_files.read_index(spark, path).withColumnRenamed("key", "doc_id")


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    lengths = token_counts.length_histogram(table(spark, sf, "documents"), tokenizer_path(), extra=1)
    return token_counts.answers(lengths)


def op11_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return mtree.nearest(table(spark, sf, "embeddings"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(table(spark, sf, "embeddings")).withColumnRenamed("_key", "vec_id")


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    found = alignment.align_corpus(table(spark, sf, "documents"), tokenizer_path(), piece_tokenizer_path())
    return found.withColumnRenamed("_key", "doc_id")


QUERIES = {
    query.__name__: query
    for query in (
        op1_mix,
        op2_line_dedup,
        op3_warc,
        op4_near_duplicates,
        op5_quality,
        op6_chat,
        op7_leaks,
        op8_language,
        op9_token_files,
        op10_token_counts,
        op11_nearest,
        op12_whitening,
        op13_alignment,
    )
}
