from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from precis.operators import lookups, vocabulary


def rows_and_table(n=300, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = [(i % 7 if i % 3 else None, [rng.choice([*words, "?", None]) for _ in range(rng.randint(0, 9))] if i % 11 else None, [rng.choice(words)] * (i % 2)) for i in range(n)]
    return rows, {w: i * 10 for i, w in enumerate(words)}


@pytest.mark.parametrize("hint", ["broadcast", "merge"])
@pytest.mark.parametrize("block", [1, 40, 500_000])
def test_elements_get_what_the_table_holds(spark, hint, block):
    """Keys repeat and are null, arrays are null or empty, a hot element stands in every row; blocks of any size."""
    rows, table = rows_and_table()
    df = spark.createDataFrame([(*r, "hot") for r in rows], "key int, a array<string>, b array<string>, _place string").repartition(4)
    known = spark.createDataFrame(list(table.items()), "token string, number int")
    out = lookups.looked_up(df, known.hint(hint), {"x": F.col("a"), "b": F.col("b")}, "token", "number", block)
    assert out.columns == ["key", "a", "_place", "x", "b"]
    got = [(r.key, r.a, r.x, r.b) for r in out.collect()]
    want = [(k, a, [table.get(t) for t in a or []], [table[t] for t in b]) for k, a, b in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_a_block_asks_once_for_each_distinct_element(spark):
    df = spark.range(2000).select(F.array(F.lit("a"), F.lit("b"), (F.col("id") % 5).cast("string")).alias("t")).coalesce(1)
    blocks = lookups.in_blocks(df, {"x": F.col("t")})
    assert blocks.filter("_values is not null").agg(F.sum(F.size("_values"))).first()[0] == 7 * blocks.filter("_values is not null").count()


@pytest.mark.parametrize("sendable", [0, 1 << 20])
@pytest.mark.parametrize("run", [4, 4096])
def test_numbers_are_read_by_place(spark, sendable, run):
    """The table as one sent array, and as runs that are joined; free numbers, unknown ones and negative ones."""
    names = {n: f"t{n}" for n in range(3, 40) if n not in (11, 12, 30)}
    table = spark.createDataFrame(list(names.items()), "id int, token string")
    rows = [(i, [3, 11, 39, 40, -1, None, i % 45][: i % 8] if i % 9 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "row int, ids array<int>").repartition(3)
    out = lookups.read_by_place(df, table, {"ids": F.col("ids")}, "id", "token", sendable, run, block_elements=50)
    got = {r.row: r.ids for r in out.collect()}
    assert got == {i: [names.get(n) for n in ids or []] for i, ids in rows}


@pytest.mark.parametrize("sendable", [0, 1 << 20])
def test_empty_tables(spark, sendable):
    table = spark.createDataFrame([(3, "a")], "id int, token string")
    df = spark.createDataFrame([(1, [3, 4])], "row int, ids array<int>")
    read = lambda d, t: [tuple(r) for r in lookups.read_by_place(d, t, {"ids": F.col("ids")}, "id", "token", sendable).collect()]
    assert read(df, table.limit(0)) == [(1, [None, None])]
    assert read(df.limit(0), table) == []
    assert read(df, table) == [(1, ["a", None])]
    assert lookups.looked_up(df.limit(0), table, {"x": F.col("ids")}, "id", "token").collect() == []


def test_rare_words_are_ranked_in_order_over_all_tasks(spark):
    df = spark.range(500).select(F.concat(F.lit("x"), F.lpad(F.col("id").cast("string"), 4, "0"), F.lit(" y y")).alias("t")).repartition(7)
    vocab = vocabulary.build_vocab(df, "t", 400).orderBy("id").collect()
    assert [(r.token, r.id, r["count"]) for r in vocab] == [("y", 3, 1000), *((f"x{i:04}", i + 4, 1) for i in range(399))]
