"""Samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 2**32


def key_hash(key: Column, seed: int = 42) -> Column:
    """A number from 0 to 2^32 - 1 that depends on the key's text and the seed alone; a null key hashes as a mark."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("\0null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Each row kept with chance `fraction`. Repeatable for the same files; other partitions give other rows."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def random_split(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Two parts without overlap that make up the whole. Same caveat as `sample_rows`; store the input first."""
    first, second = df.randomSplit([train, 1 - train], seed=seed)
    return first, second


def hash_sample(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Rows whose key hashes into the fraction: the same rows however the table is partitioned."""
    return df.filter(key_hash(F.col(key), seed) < F.lit(fraction * HASH_RANGE))


def hash_split(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """A `split` column, `train` or `validation`, from the key's hash. One pass, nothing stored."""
    is_train = key_hash(F.col(key), seed) < F.lit(train * HASH_RANGE)
    return df.withColumn("split", F.when(is_train, "train").otherwise("validation"))
