import os

import pytest

from rescuelens.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", "tests", **{
        "spark.ui.enabled": "false", "spark.driver.memory": "6g",
        "spark.sql.shuffle.partitions": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def plan_of(df):
    """Executed plan as text (before adaptive changes)."""
    return df._jdf.queryExecution().executedPlan().toString()
