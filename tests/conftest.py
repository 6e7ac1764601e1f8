import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import local_session

    session = local_session(4, 4, "4g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A DataFrame of rows and a schema string, on the given number of partitions."""

    def make(rows, schema, partitions=2):
        return spark.createDataFrame(rows, schema).repartition(partitions)

    return make


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        found = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in found), key=str)

    return collect
