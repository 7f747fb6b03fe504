"""Summaries of texts as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from precis.operators.extractive import MAX_TOKENS, MIN_TOKENS, summarize_extractive
from precis.operators.models import BATCH_SIZE, Model, summarize
from precis.session import configure


def once_per_key(stream: DataFrame, key: str, expiry: str) -> DataFrame:
    """The first row of each key; later ones within `expiry` go. Time is when a row arrives, so no row is too late."""
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", expiry)
    return arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")


def summarize_stream(
    stream: DataFrame,
    col: str,
    model: Model,
    sink: str,
    checkpoint: str,
    batch_size: int = BATCH_SIZE,
    prefix: str | None = "summarize: ",
    available_now: bool = False,
    key: str | None = None,
    expiry: str = "1 day",
) -> StreamingQuery:
    """Each new text with its summary, appended to a parquet folder once, restarts included.

    With a `key`, a row that is delivered again within `expiry` of its first arrival is not summarized again, in this run
    or a later one from the same checkpoint: the keys that have been seen are the stream's state, spread over tasks by
    key, and leave it after that time. Null is a key like any other.

    The session gets the library's settings, if it has none of its own: the size of Arrow batches bounds a task's memory.
    """
    configure(stream.sparkSession)
    if key is not None:
        stream = once_per_key(stream, key, expiry)
    out = summarize(stream, col, model, batch_size, prefix)
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(sink)


def summarize_stream_extractive(
    stream: DataFrame,
    stats: DataFrame,
    key: str,
    text: str,
    sink: str,
    checkpoint: str,
    min_tokens: int = MIN_TOKENS,
    max_tokens: int = MAX_TOKENS,
    available_now: bool = False,
    expiry: str | None = None,
) -> StreamingQuery:
    """Extractive summaries per micro-batch, each in a folder of its own that a repeated batch writes anew.

    With an `expiry`, a key that is delivered again within that time gives no further summary, see `summarize_stream`.
    """
    if expiry is not None:
        stream = once_per_key(stream, key, expiry)

    def write(batch: DataFrame, batch_id: int) -> None:
        summaries = summarize_extractive(batch, stats, key, text, min_tokens=min_tokens, max_tokens=max_tokens)
        summaries.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
