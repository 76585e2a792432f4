import pytest

from lettera.plans.catalog import Workspace
from lettera.session import local_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "4", app="tests",
        **{
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark):
    return Workspace(spark, FOLDER)


@pytest.fixture
def rows(spark):
    """DataFrame from rows and a schema text."""
    return lambda data, schema: spark.createDataFrame(data, schema)


def as_set(df, *columns):
    chosen = df.select(*columns) if columns else df
    return {tuple(r) for r in chosen.collect()}
