"""Small tables shared by the tests of this folder."""

import pytest


@pytest.fixture
def rows(spark):
    """A table from tuples and a schema, in several partitions."""

    def make(data, schema, parts=3):
        return spark.createDataFrame(data, schema).repartition(parts)

    return make
