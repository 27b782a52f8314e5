import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from vitalgrid.session import get_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "vitalgrid-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_slices(spark):
    """Series longer than 7 rows count as large, so every ordered operator works in slices."""
    spark.conf.set("spark.vitalgrid.maxSeriesRows", "7")
    yield
    spark.conf.unset("spark.vitalgrid.maxSeriesRows")


@pytest.fixture(scope="session")
def sf_dir():
    return DATA
