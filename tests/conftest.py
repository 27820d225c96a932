from __future__ import annotations

import pytest

from chartmart.session import get_spark


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        app="chartmart-tests",
        master="local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluates a Column expression over a list of texts: ``values(rule, [..])``."""

    def run(rule, items, kind="string"):
        from pyspark.sql import functions as F

        rows = [(i, item) for i, item in enumerate(items)]
        df = spark.createDataFrame(rows, f"i int, x {kind}").orderBy("i")
        return [row[0] for row in df.select(rule(F.col("x")).alias("y")).collect()]

    return run
