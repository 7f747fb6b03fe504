from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from precis.operators import rows, sampling


def test_incomplete_pairs_are_dropped_and_whitespace_kept(spark):
    df = spark.createDataFrame([("a", "b"), (None, "b"), ("a", None), ("", "b"), ("a", ""), (" ", "b")], "text string, summary string")
    kept = rows.drop_incomplete_pairs(df).collect()
    assert sorted((r.text, r.summary) for r in kept) == [(" ", "b"), ("a", "b")]


def test_columns_by_name_dataset_and_position(spark):
    df = spark.createDataFrame([("i", "d", "s", "x")], "id string, document string, summary string, extra string")
    assert rows.resolve_columns(df).first() == ("i", "d")
    assert rows.resolve_columns(df, keep=("id",)).first() == ("i", "d", "s")
    assert rows.resolve_columns(df, dataset="xsum").first() == ("d", "s")
    assert rows.resolve_columns(df, dataset="xsum", summary="extra").first() == ("d", "x")
    with pytest.raises(ValueError, match="no column 'nothing'"):
        rows.resolve_columns(df, text="nothing")


def test_prefix(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert rows.add_prefix(df, "text").first().text == "summarize: a"
    assert rows.add_prefix(df, "text", None).first().text == "a"


def test_split_counts_are_capped(spark):
    df = spark.range(10).select(F.when(F.col("id") < 7, "train").otherwise("test").alias("split"))
    assert dict(map(tuple, rows.split_counts(df, max_samples=5).collect())) == {"train": 5, "test": 3}


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumnRenamed("id", "key")
    once = sampling.hash_split(df, "key")
    again = sampling.hash_split(df.repartition(7), "key")
    assert once.exceptAll(again).count() == 0
    train = once.filter("split = 'train'").count()
    assert 1500 < train < 1700
    assert sampling.hash_sample(df, "key", 0.1).count() == sampling.hash_sample(df.repartition(3), "key", 0.1).count()


def test_random_split_is_disjoint_and_complete(spark):
    df = spark.range(0, 1000, 1, 4)
    train, validation = sampling.random_split(df)
    assert train.intersect(validation).count() == 0
    assert train.union(validation).distinct().count() == 1000
    assert sampling.sample_rows(df).exceptAll(sampling.sample_rows(df)).count() == 0
