import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lapwise.operators.ordered import HOT_ROWS_CONF  # noqa: E402
from lapwise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def hot(spark):
    """Set the row limit for one test."""

    def use(rows):
        spark.conf.set(HOT_ROWS_CONF, str(rows))

    yield use
    spark.conf.unset(HOT_ROWS_CONF)
