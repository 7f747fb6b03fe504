"""Running totals over a sorted table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.session import stored


def with_totals_before(df: DataFrame, order: list[Column], totals: dict[str, str], name: str, ranges: list[Column] | None = None) -> DataFrame:
    """The table in order, with each of `totals` (new column: summed column) as the sum over all rows before.

    The rows are range-partitioned and stored with the number of their part; one row per part is summed up alone, so
    no task holds more than a part and none of the sums depends on where the parts were cut. Ties in the order may
    fall either way between rows that differ elsewhere: pass an order that tells rows apart.

    Spark draws a sample of what it ranges by through the driver. Where the order has long values, `ranges` is a shorter
    one that agrees with it: rows that it sorts apart are sorted alike by `order`.
    """
    laid = stored(df.repartitionByRange(*(ranges or order)).withColumn("_part", F.spark_partition_id()), name)
    sums = laid.groupBy("_part").agg(*(F.sum(c).alias(f"_sum_{new}") for new, c in totals.items()))
    # One row per part: bounded by the number of shuffle partitions, not by the rows.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_part", *(F.coalesce(F.sum(f"_sum_{new}").over(before), F.lit(0)).alias(f"_at_{new}") for new in totals))
    here = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = laid.join(F.broadcast(starts), "_part")
    for new, c in totals.items():
        out = out.withColumn(new, F.col(f"_at_{new}") + F.coalesce(F.sum(c).over(here), F.lit(0)))
    return out.drop("_part", *(f"_at_{new}" for new in totals))
