"""Texts collected per group.

A group may hold a third of all rows, and its joined text may be longer than a row can be. Such a group comes out as
several rows, numbered by `part`: consecutive runs of its texts in order, of about `max_part_chars` characters each, so
that the parts put one after the other are the group's text at any limit. A group of usual size is one row with part 0.
Texts are in order of a column, nulls first, equal ones by the text itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from precis.functions.text import words
from precis.operators.running import with_totals_before
from precis.session import stored

MAX_PART_CHARS = 32 * 1024 * 1024
# Characters of a text that say to which range of equal orders it goes.
RANGE_CHARS = 64
# A group is cut down in so many slices first, then in fewer, so that the last task sees few rows of it.
SLICES = (256, 16, 1)


def large_groups(df: DataFrame, key: str, text: str, max_part_chars: int = MAX_PART_CHARS) -> DataFrame:
    """`(key, n)` of the groups that need more than one part; a single row cannot be divided.

    The sums are combined before the shuffle, so a hot group costs one row per input task.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("n"), F.sum(_chars(F.col(text))).alias("chars"))
    return sizes.filter((F.col("chars") > max_part_chars) & (F.col("n") > 1)).select(key, "n")


def _chars(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)) + F.lit(1)


def lay_out(
    df: DataFrame, key: str, text: str, order: str, max_part_chars: int = MAX_PART_CHARS
) -> DataFrame:
    """`(group, part, total, at, text)`: each row with its part, and the group's row count where the group is large.

    Rows of large groups are sorted over all tasks and summed up by ranges of the order, so a hot group is spread like
    any other rows; a row's part follows from the characters before it in its group. Which groups are large is a
    table of its own that the planner sends or shuffles by its size.
    """
    large = large_groups(df, key, text, max_part_chars).select(F.col(key).alias("_key"), F.col("n").alias("total"))
    large = stored(large, "large-groups")
    rows = df.select(F.col(key).alias("group"), F.col(order).alias("at"), F.col(text).alias("text"))
    same = F.col("group").eqNullSafe(F.col("_key"))
    usual = rows.join(large, same, "left_anti").select("group", F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("total"), "at", "text")
    big = rows.join(large, same).drop("_key").withColumn("chars", _chars(F.col("text")).cast("bigint"))
    by = [F.col("group").asc_nulls_first(), F.col("at").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # Texts are told apart by their first characters where rows are dealt out: whole ones would pass through the driver.
    ranges = [*by[:2], F.left(F.col("text"), F.lit(RANGE_CHARS)).asc_nulls_first()]
    summed = with_totals_before(big, by, {"before": "chars"}, "large-group-rows", ranges)
    firsts = summed.groupBy("group").agg(F.min("before").alias("first")).withColumnRenamed("group", "_key")
    part = F.floor((F.col("before") - F.col("first")) / max_part_chars).cast("int")
    return usual.unionByName(summed.join(firsts, same).select("group", part.alias("part"), "total", "at", "text"))


def texts_in_order(at: str = "at", text: str = "text") -> Column:
    """Aggregate: the non-null texts as structs, sorted by `at`."""
    entry = F.struct(F.col(at).alias("at"), F.col(text).alias("text"))
    return F.sort_array(F.collect_list(F.when(F.col(text).isNotNull(), entry)))


def collect_texts(
    df: DataFrame, key: str, text: str, order: str, max_part_chars: int = MAX_PART_CHARS
) -> DataFrame:
    """`(key, part, n, texts)`: the group's rows counted, its non-null texts listed by `order`; null is a group too."""
    return (
        lay_out(df, key, text, order, max_part_chars)
        .groupBy("group", "part")
        .agg(F.coalesce(F.max("total"), F.count("*")).alias("n"), texts_in_order().alias("entries"))
        .select(F.col("group").alias(key), "part", "n", F.col("entries.text").alias("texts"))
    )


def count_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows per group, nulls included."""
    return df.groupBy(key).agg(F.count("*").alias("n"))


def min_group_size(df: DataFrame, n: int = 10) -> DataFrame:
    """Groups of at least `n` rows."""
    return df.filter(F.col("n") >= n)


def concat_texts(texts: Column, sep: str = " ") -> Column:
    """A list of texts as one text."""
    return F.concat_ws(sep, texts)


def review_by_group(
    df: DataFrame,
    key: str,
    text: str,
    order: str,
    min_n: int = 10,
    sep: str = " ",
    max_part_chars: int = MAX_PART_CHARS,
) -> DataFrame:
    """`(key, part, n, reviews)` for groups of at least `min_n` rows; see the module's note on `part`."""
    groups = min_group_size(collect_texts(df, key, text, order, max_part_chars), min_n)
    return groups.select(key, "part", "n", concat_texts(F.col("texts"), sep).alias("reviews"))


def first_rows(df: DataFrame, key: list[str], by: list[Column], n: int) -> DataFrame:
    """The first `n` rows per group in the order `by`.

    A rank over a hot group would pass it through one task. Ranking inside slices first leaves `n` rows per slice;
    slices are put together sixteen at a time and ranked again, so no task sees more than 16 * `n` rows of a group
    beyond its own map task's. Spark cuts each map task to `n` rows per slice before every shuffle. A row among the first
    `n` of its group is among the first `n` of any slice, so the slices may follow from where the row lies. Rows that
    `by` doesn't tell apart may stand for each other.
    """
    df = df.withColumn("_slice", F.spark_partition_id() % SLICES[0])
    for slices in SLICES:
        # Each level puts together slices of the level before.
        df = df.withColumn("_slice", F.floor(F.col("_slice") * slices / SLICES[0]).cast("int") * F.lit(SLICES[0] // slices))
        within = Window.partitionBy(*key, "_slice").orderBy(*by)
        df = df.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= n)
    return df.drop("_slice", "_rank")


def model_input_by_group(
    df: DataFrame, key: str, text: str, order: str, min_n: int = 10, max_tokens: int = 512, sep: str = " "
) -> DataFrame:
    """`(key, n, reviews)` with no more of each group's text than a model of `max_tokens` input tokens reads.

    Texts are taken by `order`, nulls first, equal ones by the text, until their words cover the budget; `n` still counts all rows. A text without a word
    is passed over and any other costs at least one, so the first `max_tokens` texts are enough, and no task holds
    more of a group.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(order).alias("at"), F.col(text).alias("text"))
    by = [F.col("at").asc_nulls_first(), F.col("text").asc_nulls_first()]
    before = Window.partitionBy("_key").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    cost = F.size(F.filter(words(F.col("text")), lambda word: F.length(word) > 0))
    filled = rows.filter(F.trim("text") != "").withColumn("cost", cost)
    taken = (
        first_rows(filled, ["_key"], by, max_tokens)
        .withColumn("before", F.coalesce(F.sum("cost").over(before), F.lit(0)))
        .filter(F.col("before") < max_tokens)
        .select("_key", "at", "text")
    )
    # Counts and texts meet in one grouping: a join would treat null keys apart.
    return (
        taken.unionByName(rows.groupBy("_key").agg(F.count("*").alias("n")), allowMissingColumns=True)
        .groupBy("_key")
        .agg(F.max("n").alias("n"), texts_in_order().alias("entries"))
        .filter(F.col("n") >= min_n)
        .select(F.col("_key").alias(key), "n", concat_texts(F.col("entries.text"), sep).alias("reviews"))
    )
