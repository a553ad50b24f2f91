import pytest
from samples import SCHEMA, rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark):
    """Columns whose names operators might use themselves."""
    return spark.createDataFrame(rows(), SCHEMA).selectExpr("*", "1 AS size", "'x' AS place", "2 AS h", "3 AS id", "'y' AS bucket", "0 AS shard", "'k' AS key")
