import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from promptloom.session import get_session, remove_stages  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="promptloom-warehouse-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    remove_stages(session)
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


def values(df):
    """The only column of a frame as a list."""
    return [r[0] for r in df.collect()]


@pytest.fixture
def column(spark):
    """Evaluate a column function over string inputs: ``column(fn, [inputs])``."""

    def evaluate(function, inputs):
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").coalesce(1)
        return [r[0] for r in rows.orderBy("i").select(function("x")).collect()]

    return evaluate
