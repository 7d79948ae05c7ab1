import pytest


@pytest.fixture
def frame(spark):
    """Small tables from Python rows, in two partitions."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema).repartition(2)

    return make
