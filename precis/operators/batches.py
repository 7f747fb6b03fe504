"""Padded training batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.functions.tokens import IGNORE_ID, PAD_ID, pad_to_length
from precis.operators.running import with_totals_before
from precis.session import stored


def pad_batches(df: DataFrame, key: str, batch_size: int = 8, label_pad: int = IGNORE_ID, multiple_of: int | None = None) -> DataFrame:
    """`(key, batch, input_ids, labels)`, each array as long as the longest of its batch.

    Rows are numbered through the whole table in order of their key, null keys first, rows of one key by a hash of
    their ids; every `batch_size` of them are a batch, so only the last batch can be short. `multiple_of` rounds lengths up
    (8 suits half precision). A null array counts as empty.

    Numbers and lengths come from a table of keys and sizes: it is sorted over all tasks and summed by range, and the
    longest row of a batch is a second grouping of it. Arrays are moved once, when a row gets its batch.
    """
    none = F.array().cast("array<int>")
    arrays = [F.coalesce(c, none).alias(c) for c in ("input_ids", "labels")]
    # Stored with a number per row, so that the number stays with its row.
    rows = stored(df.select(F.col(key).alias("_key"), *arrays, F.monotonically_increasing_id().alias("_row")), "batch-rows")
    sizes = rows.select("_row", "_key", F.size("input_ids").alias("_inputs"), F.size("labels").alias("_labels"), F.xxhash64("input_ids", "labels").alias("_tie"), F.lit(1).alias("_one"))
    numbered = with_totals_before(sizes, [F.col("_key").asc_nulls_first(), F.col("_tie"), F.col("_row")], {"_at": "_one"}, "batch-places")
    batched = stored(numbered.select("_row", "_inputs", "_labels", F.floor(F.col("_at") / batch_size).cast("bigint").alias("batch")), "batches")

    def longest(col: str):
        size = F.max(col)
        return size if multiple_of is None else (F.ceil(size / multiple_of) * multiple_of).cast("int")

    lengths = batched.groupBy("batch").agg(longest("_inputs").alias("_inputs"), longest("_labels").alias("_labels"))
    placed = batched.select("_row", "batch").join(lengths, "batch")
    return rows.join(placed, "_row").select(
        F.col("_key").alias(key),
        "batch",
        pad_to_length(F.col("input_ids"), F.col("_inputs"), PAD_ID).alias("input_ids"),
        pad_to_length(F.col("labels"), F.col("_labels"), label_pad).alias("labels"),
    )
