"""Arrays of elements looked up in a table, block by block.

A block is a run of rows as they lie in a task. Each of its distinct elements is one row of the join with the table, however
often the block holds it, and the answers come back to the block as one array that the rows read by place. Texts and other
columns ride along with their row and never meet the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from precis.session import stored

# Elements of a block: enough that most of them repeat, few enough for one row with a block's distinct ones.
BLOCK_ELEMENTS = 500_000


# What makes a batch of texts one of arrays of strings.
Cut = Callable[[pa.Array], pa.ListArray]


def in_blocks(df: DataFrame, arrays: dict[str, Column], block_elements: int = BLOCK_ELEMENTS, keep: list[str] | None = None, cuts: dict[str, Cut] | None = None) -> DataFrame:
    """Rows `(_block, _rest, _0, _1, ...)` with each array as places in the block's `_values`, which is one more row.
    `_rest` are the columns of `keep`, all of them by default. With `cuts`, one for each array, the arrays are given as
    texts and cut here, by batch.

    The table is stored, so a row's block is the same for all that read it, also when a task has to be run again.
    """
    names = [f"`{c}`" for c in (df.columns if keep is None else keep)]
    given = df.select(F.struct(*names).alias("_rest"), *[array.alias(f"_{i}") for i, array in enumerate(arrays.values())])
    kind = T.ArrayType(T.StringType()) if cuts else given.schema["_0"].dataType
    makers = [cuts[name] for name in arrays] if cuts else []
    sides = [f"_{i}" for i in range(len(arrays))]
    fields = [T.StructField("_block", T.StringType()), given.schema["_rest"], *(T.StructField(s, T.ArrayType(T.IntegerType())) for s in sides), T.StructField("_values", kind)]
    fields[1] = T.StructField("_rest", given.schema["_rest"].dataType)  # null in a block's own row

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            if makers:
                made = [make(whole.column(s)) for s, make in zip(sides, makers, strict=True)]
                whole = pa.RecordBatch.from_arrays([whole.column("_rest"), *made], names=["_rest", *sides])
            for batch in _runs(whole, sides, block_elements):
                columns = [batch.column(s) for s in sides]
                lengths = [np.asarray(pc.fill_null(pc.list_value_length(c), 0)) for c in columns]
                coded = pa.concat_arrays([c.flatten() for c in columns]).dictionary_encode()
                at, places = 0, []
                for each in lengths:
                    to = np.concatenate([[0], np.cumsum(each)])
                    places.append(pa.ListArray.from_arrays(pa.array(to, pa.int32()), coded.indices.slice(at, int(to[-1])).cast(pa.int32())))
                    at += int(to[-1])
                name, rows, values = f"{part}-{number}", batch.num_rows, coded.dictionary
                number += 1
                held = pa.nulls(rows, pa.list_(values.type))
                yield pa.RecordBatch.from_arrays([pa.array([name] * rows), batch.column("_rest"), *places, held], names=columns_of)
                held = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.nulls(1, batch.column("_rest").type), *(pa.nulls(1, pa.list_(pa.int32())) for _ in sides), held], names=columns_of)

    columns_of = ["_block", "_rest", *sides, "_values"]
    return stored(given.mapInArrow(cut, T.StructType(fields)), "blocks")


def _runs(batch: pa.RecordBatch, sides: list[str], most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `most` elements, a longer row alone."""
    sizes = sum(np.asarray(pc.fill_null(pc.list_value_length(batch.column(s)), 0)).astype(np.int64) for s in sides)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def answered(columns: list[str], blocks: DataFrame, answers: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """The rows of `blocks` with their `columns`, each of `arrays` read by place from its block's row of `answers(_block, _answers)`.

    A column of an array's name is replaced. An array of null comes back empty, an element without an answer as null.
    """
    both = blocks.filter("_values is null").join(answers, "_block", "left")
    made = {name: F.transform(F.col(f"_{i}"), lambda place: F.get("_answers", place)).alias(name) for i, name in enumerate(arrays)}
    kept = [F.col("_rest").getField(c).alias(c) for c in columns if c not in made]
    return both.select(*kept, *made.values())


def looked_up(df: DataFrame, table: DataFrame, arrays: dict[str, Column], source: str, target: str, block_elements: int = BLOCK_ELEMENTS, keep: list[str] | None = None, cuts: dict[str, Cut] | None = None) -> DataFrame:
    """`df` with a column per array: its elements looked up in the table's `source`, as its `target`, in order.

    Elements that the table lacks, null ones among them, are null; a null array is empty. Every row stays, keys may repeat
    or be null. The planner sends a small table to all tasks and shuffles a large one. With `keep` only these columns of
    `df` come out beside the arrays, and only they are moved: rows are stored and joined, so a text that is no longer
    wanted costs both. For `cuts` see `in_blocks`.
    """
    blocks = in_blocks(df, arrays, block_elements, keep, cuts)
    asked = blocks.filter("_values is not null").select("_block", F.posexplode("_values").alias("_place", "_value"))
    known = table.select(F.col(source).alias("_known"), F.col(target).alias("_found"))
    found = asked.join(known, F.col("_value") == F.col("_known"), "left")
    answers = found.groupBy("_block").agg(F.sort_array(F.collect_list(F.struct("_place", "_found"))).alias("_a"))
    return answered(df.columns if keep is None else keep, blocks, answers.select("_block", F.col("_a._found").alias("_answers")), arrays)


# Tables with dense ids, as arrays of consecutive ones

RUN = 4096
SENDABLE_BYTES = 64 * 1024 * 1024


def in_runs(table: DataFrame, number: str, value: str, run: int = RUN) -> DataFrame:
    """`(_run, _first, _held)`: the values of the numbers from `run * _run + _first` on, null where a number is free.

    Numbers are whole, 0 or more, each once. A run is one row, so its size is bounded whatever the table's.
    """
    own = table.filter(F.col(number) >= 0).select(F.floor(F.col(number) / run).cast("int").alias("_run"), (F.col(number) % run).cast("int").alias("_at"), F.col(value).alias("_value"))
    runs = own.groupBy("_run").agg(F.sort_array(F.collect_list(F.struct("_at", "_value"))).alias("_e"), F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    # Dense numbers are taken as they stand; only a run with gaps is looked through number by number.
    gaps = F.transform(F.sequence("_first", "_last"), lambda at: F.map_from_entries("_e")[at])
    dense = F.size("_e") == F.col("_last") - F.col("_first") + 1
    return runs.select("_run", "_first", F.when(dense, F.col("_e._value")).otherwise(gaps).alias("_held"))


def read_by_place(df: DataFrame, table: DataFrame, arrays: dict[str, Column], number: str, value: str, sendable: int = SENDABLE_BYTES, run: int = RUN, block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """`df` with a column per array: its numbers as the values that stand at their places in the table.

    Numbers without a value, null ones among them, give null; a null array is empty. A string table of up to `sendable` bytes is sent to the tasks as
    one array and read in Arrow batches, without any shuffle of rows. A larger one stays as runs of consecutive
    numbers: a block's distinct numbers ask by run, one row of the join per block and run.
    """
    size = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.col(value).cast("string"))), F.lit(0)).alias("bytes"), F.max(number).alias("last")).first()  # one row
    # Free numbers take room in the array too.
    if size["bytes"] + 8 * ((size["last"] or 0) + 1) <= sendable:
        return _read_sent(df, table, arrays, number, value, size["last"])
    blocks = in_blocks(df, arrays, block_elements)
    asked = blocks.filter("_values is not null").select("_block", F.posexplode("_values").alias("_place", "_value")).filter(F.col("_value") >= 0)
    by_run = asked.groupBy("_block", F.floor(F.col("_value") / run).cast("int").alias("_run")).agg(F.collect_list(F.struct("_place", (F.col("_value") % run).cast("int").alias("_at"))).alias("_asked"))
    met = by_run.join(in_runs(table, number, value, run), "_run")
    found = met.select("_block", F.transform("_asked", lambda a: F.struct(a["_place"].alias("_place"), F.get("_held", a["_at"] - F.col("_first")).alias("_found"))).alias("_a"))
    pairs = found.groupBy("_block").agg(F.sort_array(F.flatten(F.collect_list("_a"))).alias("_a"))
    # Numbers that no run holds leave gaps among the places: the block's own numbers say where.
    places = blocks.filter("_values is not null").select("_block", F.size("_values").alias("_n"))
    whole = places.join(pairs, "_block", "left")
    complete = F.size("_a") == F.col("_n")
    as_map = F.map_from_entries(F.coalesce(F.col("_a"), F.array().cast(pairs.schema["_a"].dataType)))
    gaps = F.transform(F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1)), lambda p: as_map[p])
    answers = whole.select("_block", F.when(complete, F.col("_a._found")).otherwise(gaps).alias("_answers"))
    return answered(df.columns, blocks, answers, arrays)


def _read_sent(df: DataFrame, table: DataFrame, arrays: dict[str, Column], number: str, value: str, last: int | None) -> DataFrame:
    """The table's values as one sent array, read in batches. Bounded by what `read_by_place` has measured."""
    spark = df.sparkSession
    rows = table.filter(F.col(number) >= 0).select(F.col(number).cast("bigint"), value).toArrow()
    values = rows.column(1).combine_chunks()
    at = np.full((last if last is not None and last >= 0 else -1) + 1, -1, np.int64)
    at[np.asarray(rows.column(0))] = np.arange(rows.num_rows)
    sent = spark.sparkContext.broadcast(values.take(pa.array(at, mask=at < 0)))
    made = dict(zip([f"_{i}" for i in range(len(arrays))], arrays, strict=True))
    own = [c for c in df.columns if c not in arrays]
    given = df.select(F.struct(*[f"`{c}`" for c in own] or [F.lit(None).cast("int").alias("_none")]).alias("_rest"), *[array.alias(s) for s, array in zip(made, arrays.values(), strict=True)])
    kind = T.ArrayType(table.schema[value].dataType)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for batch in batches:
            out = []
            for side in made:
                lists = batch.column(side)
                to = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))])
                flat = lists.flatten().cast(pa.int64())
                known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(held)))
                out.append(pa.ListArray.from_arrays(pa.array(to, pa.int32()), held.take(pc.if_else(known, flat, pa.scalar(None, pa.int64())))))
            yield pa.RecordBatch.from_arrays([batch.column("_rest"), *out], names=["_rest", *made])

    fields = [T.StructField("_rest", given.schema["_rest"].dataType), *(T.StructField(s, kind) for s in made)]
    found = given.mapInArrow(read, T.StructType(fields))
    return found.select(*[F.col("_rest").getField(c).alias(c) for c in own], *[F.col(s).alias(name) for s, name in made.items()])
