"""Session settings and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows hold long texts and arrays: smaller batches keep an Arrow batch in tens of megabytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # However long a row is: what a task holds of rows on their way to Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # First rows of a group are cut before the shuffle up to this many; the default is less than a model's input.
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
}

# What a session says when nobody has set these.
DEFAULTS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    "spark.sql.execution.arrow.pyspark.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; on a cluster the submitter gives the session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Puts `SETTINGS` into a session that a cluster's submitter has given; a setting of its own stays as it is."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) in (None, DEFAULTS.get(name)):
            spark.conf.set(name, value)
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder; a temporary one only on a single machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="precis-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *key: str) -> DataFrame:
    """A scan of fewer splits than cores (gzip, one row group) laid out over all of them; others as they are.

    The number of splits grows with the data, so a large table is never shuffled here. Rows go by a hash of the columns
    that name them rather than round-robin, so that a task that is run again gives the same rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back, for results that several steps read."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
