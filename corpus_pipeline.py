"""The corpus pipeline: documents filtered, deduplicated, decontaminated, mixed and written as token ids.

Every stage reads whole texts, takes an empty table (its result is empty), keeps columns it doesn't know, whatever their
names, and treats rows of one doc_id, or of none, each for itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from precis.llm import decontamination, mixing, ngram_join, quality, token_files
from precis.llm.common import saved, table
from precis.llm.queries import tokenizer_path
from precis.session import configure, scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go: null and empty texts have too few words, so they go here. Repeated rows fare alike."""
    configure(spark)
    return quality.keep_good(docs, lang="lang")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least doc_id stays, nulls last; of equal rows one. Texts without
    words are in no group and stay."""
    configure(spark)
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows of the same text alike; null texts and those without a word stay."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the training mix takes: those of favoured sources twice, some of the others not at all.

    A null source is a source of its own. Texts without words take up no room: they come once if their place is reached. Ties in
    the order go by doc_id. The files of the next stage are in order of doc_id, so the mix's own order ends here."""
    return mixing.mix(docs, position=None)


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix; the result is their index: `doc_id, start, n_tokens, ids_crc32` per row.

    In ascending order of doc_id, nulls first, rows of one doc_id by their text; a null text is an end id alone."""
    configure(spark)
    path = scratch_folder(spark, "corpus-token-ids")
    token_files.write(docs, path, tokenizer_path())
    return token_files.read_index(spark, path).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_weights", mixing_to_weights),
    ("token_id_output", token_id_output),
]

# SQL has no byte-level tokenizer; the tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is stored and read back as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
