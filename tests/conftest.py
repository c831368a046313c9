import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillsight.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frame from rows and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    """Physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def values(df, *columns):
    """Sorted rows as tuples."""
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)
