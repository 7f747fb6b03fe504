from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from precis.operators import groups, running


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows under one key, and a null key."""
    keys = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 17))
    text = F.when(F.col("id") % 11 != 0, F.concat(F.lit("text number "), F.col("id")))
    return spark.range(0, 600, 1, 5).select(keys.alias("key"), F.col("id").alias("row"), text.alias("text")).cache()


def by_key(hot):
    out = defaultdict(list)
    for r in sorted(hot.collect(), key=lambda r: r.row):
        out[r.key].append(r)
    return out


def test_usual_groups_are_one_row_in_order(hot):
    want = by_key(hot)
    got = groups.review_by_group(hot, "key", "text", "row", min_n=1).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.part == 0 and r.n == len(want[r.key])
        assert r.reviews == " ".join(w.text for w in want[r.key] if w.text is not None)


def test_a_large_group_keeps_every_text_over_its_parts(hot):
    want = by_key(hot)
    got = groups.collect_texts(hot, "key", "text", "row", max_part_chars=400).collect()
    parts = defaultdict(list)
    for r in got:
        assert r.n == len(want[r.key])
        numbers = [int(t.split()[-1]) for t in r.texts]
        assert numbers == sorted(numbers)
        parts[r.key].append(r)
    assert len(parts["hot"]) > 5
    for key, rows in parts.items():
        texts = sorted(t for r in rows for t in r.texts)
        assert texts == sorted(w.text for w in want[key] if w.text is not None)


@pytest.mark.parametrize("limit", [1, 50, 400, 10**6])
def test_parts_put_together_are_the_group(spark, hot, limit):
    """At any limit, also with equal and null orders."""
    odd = spark.createDataFrame([("odd", i % 3 or None, f"text {i}") for i in range(40)], "key string, row long, text string")
    both = hot.select("key", "row", "text").unionByName(odd)
    whole = {r.key: r.reviews for r in groups.review_by_group(both, "key", "text", "row", min_n=1).collect()}
    parts = defaultdict(list)
    for r in groups.review_by_group(both, "key", "text", "row", min_n=1, max_part_chars=limit).collect():
        parts[r.key].append((r.part, r.reviews))
    assert {k: " ".join(t for _, t in sorted(v) if t) for k, v in parts.items()} == whole
    if limit <= 400:
        assert len(parts["hot"]) > 5 and all(len(t) <= limit + 20 for _, t in parts["hot"])


def test_minimum_counts_rows_with_null_texts(spark):
    df = spark.createDataFrame([("a", i, None if i else "x") for i in range(10)] + [("b", 0, "y")], "key string, row int, text string")
    assert [tuple(r) for r in groups.review_by_group(df, "key", "text", "row").collect()] == [("a", 0, 10, "x")]


def test_first_rows_equals_one_rank_per_group(hot):
    got = groups.first_rows(hot.select("key", "row"), ["key"], [F.desc("row")], 7).collect()
    want = by_key(hot)
    assert sorted((r.key or "", r.row) for r in got) == sorted(
        (key or "", r.row) for key, rows in want.items() for r in rows[-7:]
    )


def test_model_input_covers_the_budget_and_no_more(hot):
    want = by_key(hot)
    for r in groups.model_input_by_group(hot, "key", "text", "row", min_n=1, max_tokens=10).collect():
        texts = [w.text for w in want[r.key] if w.text is not None]
        assert r.n == len(want[r.key])
        assert r.reviews == " ".join(texts[:4])  # three words each: the fourth text passes ten


def test_no_task_gets_a_hot_group_whole(hot):
    """The ranks inside slices are cut to size before the shuffle, and the slices before the last rank."""
    df = groups.first_rows(hot.select("key", "row"), ["key"], [F.asc("row")], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_equal_order_values_go_by_text_whatever_the_partitions(spark, partitions):
    df = spark.createDataFrame([("k", None if i < 3 else 5, f"t{i:02}") for i in range(40)], "key string, at int, text string")
    row = groups.model_input_by_group(df.repartition(partitions), "key", "text", "at", max_tokens=6).first()
    assert (row.n, row.reviews) == (40, "t00 t01 t02 t03 t04 t05")


def test_first_rows_of_one_group_of_all_rows(spark):
    df = spark.range(20_000).select(F.lit(1).alias("key"), (F.col("id") * 7919 % 20_000).alias("at")).repartition(40)
    got = groups.first_rows(df, ["key"], [F.asc("at")], 50)
    assert sorted(r["at"] for r in got.collect()) == list(range(50))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 4


def test_whole_texts_are_not_sampled_through_the_driver(hot, monkeypatch):
    """Spark samples what it ranges by: rows of large groups are dealt out by the beginnings of their texts."""
    plans, kept = [], running.stored
    monkeypatch.setattr(running, "stored", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name))
    groups.collect_texts(hot, "key", "text", "row", max_part_chars=400)
    ranged = [line for plan in plans for line in plan.splitlines() if "rangepartitioning" in line]
    assert ranged and not any(re.search(r"text#\d+ ASC", line) for line in ranged)


def test_equal_beginnings_still_go_by_the_whole_text(spark):
    texts = [f"{'same ' * 40}{i:03}" for i in range(60)]
    df = spark.createDataFrame([("k", 1, t) for t in reversed(texts)], "key string, at int, text string").repartition(5)
    rows = groups.collect_texts(df, "key", "text", "at", max_part_chars=1000).orderBy("part").collect()
    assert len(rows) > 5 and [t for r in rows for t in r.texts] == texts
