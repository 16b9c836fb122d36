import pytest


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make
