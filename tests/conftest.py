from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from precis.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, shuffle_partitions=4, memory="4g")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture
def values(spark):
    """The values of a column expression over hand-made rows, in order."""
    from pyspark.sql import functions as F

    def run(rows, schema, column, into="value"):
        df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"row int, {schema}")
        return [r[into] for r in df.withColumn(into, column).orderBy(F.col("row")).collect()]

    return run
