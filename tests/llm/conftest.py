import pytest


@pytest.fixture(scope="session")
def table(spark):
    """A table of a few rows; ``parts`` spreads them over so many partitions."""
    def make(rows, schema, parts=2):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make
