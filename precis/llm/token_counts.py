"""Token counts: an exact histogram of encoded lengths that answers for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import saved, with_totals_before
from precis.llm.tokenizing import encoder, in_portions


def encoded_lengths(docs: DataFrame, tokenizer: str, text: str = "text", key: str | None = None) -> DataFrame:
    """`(n_tokens)`, or `(_key, n_tokens)` with a key column: the number of ids of every whole text; null texts have none."""
    own = ([F.col(f"`{key}`").alias("_key")] if key else []) + [F.col(f"`{text}`").alias("_text")]
    fields = docs.select(*own)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(tokenizer)
        for batch in batches:
            texts = batch.column("_text")
            for a, b in in_portions(texts):
                lengths = pa.array(codes.lengths(texts.slice(a, b - a)), pa.int64())
                own = [batch.column(c).slice(a, b - a) for c in batch.schema.names[:-1]]
                yield pa.RecordBatch.from_arrays([*own, lengths], names=[*batch.schema.names[:-1], "n_tokens"])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in fields.schema.fields[:-1]]
    return fields.mapInArrow(measure, ", ".join([*kinds, "n_tokens bigint"]))


def length_histogram(docs: DataFrame, tokenizer: str, text: str = "text", extra: int = 0) -> DataFrame:
    """`(n_tokens, docs)`: how many documents have each encoded length, `extra` (an end id) counted with each.

    Every task counts its own rows by length before the shuffle, so what is moved is a row per task and length.
    """
    lengths = encoded_lengths(docs, tokenizer, text).select((F.col("n_tokens") + extra).alias("n_tokens"))
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def answers(histogram: DataFrame) -> DataFrame:
    """For every length that occurs, taken as a context limit:

    `docs_longer`, `docs_up_to`, `share_up_to` (of all documents; the least length with a share of q or more is the
    q-quantile), `total_tokens` of all documents, `truncated_total` when longer ones are cut to the limit, and
    `lost_tokens`, the difference. All are sums over the lengths above. An empty table gives no rows.
    """
    table = saved(histogram.withColumn("tokens", F.col("n_tokens") * F.col("docs")), "lengths")
    above = {"docs_longer": "docs", "tokens_longer": "tokens"}
    sums = with_totals_before(table, [F.col("n_tokens").desc()], above, "length-sums")
    total = table.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()  # one row
    lost = F.col("tokens_longer") - F.col("n_tokens") * F.col("docs_longer")
    return sums.select(
        "n_tokens",
        "docs",
        "docs_longer",
        (F.lit(total["docs"] or 0) - F.col("docs_longer")).alias("docs_up_to"),
        ((F.lit(total["docs"] or 0) - F.col("docs_longer")) / F.lit(float(total["docs"] or 1))).alias("share_up_to"),
        F.lit(total["tokens"] or 0).cast("long").alias("total_tokens"),
        (F.lit(total["tokens"] or 0) - lost).alias("truncated_total"),
        lost.alias("lost_tokens"),
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """`(context_limit, docs, docs_cut, total_tokens, truncated_total)` for limits that need not occur as lengths."""
    each = histogram.select("*", F.explode(F.array(*(F.lit(x).cast("long") for x in limits))).alias("context_limit"))
    longer = F.col("n_tokens") > F.col("context_limit")
    return each.groupBy("context_limit").agg(
        F.sum("docs").alias("docs"),
        F.sum(F.when(longer, F.col("docs")).otherwise(0)).alias("docs_cut"),
        F.sum(F.col("n_tokens") * F.col("docs")).alias("total_tokens"),
        F.sum(F.least("n_tokens", "context_limit") * F.col("docs")).alias("truncated_total"),
    )


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """`(share, n_tokens)`: the least length that at least this share of the documents does not exceed."""
    each = answers(histogram).select("n_tokens", "share_up_to", F.explode(F.array(*(F.lit(float(x)) for x in shares))).alias("share"))
    return each.filter("share_up_to >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
