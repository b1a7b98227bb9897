import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weftline.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "weftline-tests",
        "local[8]",
        spark_sql_shuffle_partitions=4,
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    return session


@pytest.fixture
def lines(spark):
    """One-column text DataFrame from Python strings."""
    return lambda *values: spark.createDataFrame([(value,) for value in values], "value string")
