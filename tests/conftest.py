import pytest

from dimlathe.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from a DDL schema and tuples."""

    def make(ddl, *data):
        return spark.createDataFrame(list(data), ddl)

    return make


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
